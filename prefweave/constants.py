"""Workload defaults shared by the operators and plans."""

# ---------------------------------------------------------------------------
# The reference run's workload constants (sizes and settings,
# not results). Operators use them as defaults; every one is a parameter.
#   Sampled pairs: 13,750; test share of the sample: 0.2 (11,000 / 2,750)
#   Length percentile target: 97
#   Prompt token limit: 1024; whole-sequence token limit: 1512
#   Preference loss: sigmoid with beta 0.1
#   Logging interval: 25 steps; evaluation interval: 700 steps
# ---------------------------------------------------------------------------
SAMPLE_SIZE = 13_750
TEST_FRACTION = 0.2
TARGET_PERCENTILE = 97
MAX_PROMPT_LENGTH = 1024
MAX_LENGTH = 1512
BETA = 0.1
LOGGING_STEPS = 25
EVAL_STEPS = 700

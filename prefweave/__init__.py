"""prefweave: preference-data preparation and evaluation as Spark DataFrame jobs.

Layout:
  schemas     explicit schemas for every table the library reads or writes
  session     session defaults and the shared scratch location
  functions/  Column builders (conversation arrays, chat templates, tokens, metrics)
  operators/  DataFrame -> DataFrame operators built from those columns
  sources/    readers, writers, build-once materialisation, derived test inputs
  plans/      end-to-end jobs and the registered query catalog
  streaming/  Structured Streaming form of the training metric log
"""

__version__ = "0.1.0"

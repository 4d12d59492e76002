"""tillscope: retail point-of-sale audit as Spark DataFrame jobs.

Public entry points (each takes and returns DataFrames on the caller's session):

* ingest:      ``streaming.ingest.ingest`` / ``start_ingest`` / ``kafka_source`` / ``file_message_source``
* messages:    ``sources.messages.encode_messages`` / ``decode_messages`` / ``publish_messages``
* Bronze:      ``sources.bronze.read_bronze`` / ``write_bronze_batch``
* Silver:      ``operators.silver.silver_flagged`` / ``silver_valid`` / ``silver_rejects`` / ``run_silver``
* dedup:       ``operators.dedup.dedup_latest``
* checks:      ``operators.profile`` / ``operators.quality.run_suite`` / ``functions.contract.contract_violations``
* gold:        ``operators.gold`` / ``operators.model_tests.model_test_report``
* tables:      ``sources.snapshots`` (versioned Parquet) / ``sources.csv_export``
* chain:       ``plans.pipeline.run_pipeline``
"""

__version__ = "0.1.0"

"""gaugeflow: sensor messages and snapshots to queryable, keyed Parquet tables on Spark."""

"""ledgerloom: a Spark-first engine for two-ledger reconciliation and large-scale data processing."""

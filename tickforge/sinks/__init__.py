"""Writers: Bronze JSON, Silver parquet, dead letter, Gold tables, exports."""

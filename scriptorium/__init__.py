"""scriptorium: transcript curation on Spark."""

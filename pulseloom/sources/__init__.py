"""File sources and sinks, load profiles and the ingestion ledger."""

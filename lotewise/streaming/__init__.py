"""The incremental form: each cycle takes what is new and stops."""

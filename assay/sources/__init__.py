"""Table scans, artefact sinks and the run-history store."""

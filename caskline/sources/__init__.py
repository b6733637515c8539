"""Raw file ingest, load control and versioned publishing."""

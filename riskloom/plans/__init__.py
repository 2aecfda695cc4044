"""End-to-end jobs composed from operators: training run, batch scoring,
log monitoring, tokenisation and the lake-operations jobs."""

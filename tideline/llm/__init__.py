"""Training-data operators: filtering, cleaning, near-duplicate and tokenising
jobs over document tables.  Nothing outside this folder (and
``corpus_pipeline.py``) imports it; queries are collected in ``queries.py``."""

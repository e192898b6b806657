"""Operators for large-scale training-data pipelines.

One module per operator; ``queries.py`` registers them for the driver.
Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""

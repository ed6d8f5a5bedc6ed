"""tidemark: content-momentum analytics expressed as Spark DataFrame plans.

Raw nested snapshots (bronze) are flattened, de-duplicated and turned into
per-minute rates and recency-decayed momentum (silver); titles are grouped
into topics and rolled up per topic and hour with a rising score (gold);
dashboard questions are plain DataFrame functions over gold.
"""

__version__ = "0.1.0"

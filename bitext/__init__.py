"""bitext: Spark-native operators for parallel-text corpora.

Every operator is a function DataFrame -> DataFrame (or Column -> Column)
built on the public PySpark API.  Sub-packages:

* ``functions`` – Column-level helpers (text patterns, array layout, vector math)
* ``sources``   – table readers, derived fixtures, vocabulary store, snapshots
* ``operators`` – DataFrame operators (cleaning, sampling, BPE, layout,
                  attention, decoding, BLEU, losses)
* ``plans``     – compositions answering whole questions (funnel, translate, sweeps)
                  and the registry of named queries
* ``streaming`` – resumable Structured Streaming preparation job
"""


"""sheaf: a PySpark-native library for four query families.

* ratings: top-T products by their highest user-mean-centred rating;
* word count: one-round, salted and partition-wise corpus word counts,
  vocabulary size and average word length;
* silhouette: seeded per-cluster sampling and exact / approximate
  silhouette of a labelled clustering, from per-cluster moments;
* k-sweep: k-means for a range of k, each scored by its silhouette.

Every operator is a function ``DataFrame -> DataFrame`` built from
built-in column expressions, so Catalyst plans and Tungsten executes it.
"""

__version__ = "0.1.0"

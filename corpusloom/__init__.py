"""corpusloom: Spark-native analysis and curation of aligned text corpora."""

"""clickforge: Spark-native CTR feature engineering, profiling and classification."""

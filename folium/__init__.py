"""folium: a Spark-native engine that turns versioned documentation into datasets for language models."""

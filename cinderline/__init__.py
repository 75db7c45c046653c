"""cinderline: Spark-native analytics over time-stamped point detections."""

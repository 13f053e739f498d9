"""skysift: Spark-native analytics for tiled imagery and object detections."""

"""deskmetrics: Spark-native help-desk ticket analytics."""

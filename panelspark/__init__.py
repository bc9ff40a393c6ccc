"""Spark-native jobs over entity x period panels."""

"""Spark-native analytics over vision annotations, duplicate files and object tracks."""

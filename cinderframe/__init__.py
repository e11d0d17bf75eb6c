"""Spark-native evaluation of fire-spread simulations."""

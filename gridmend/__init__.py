"""Spark-native cleaning, bias adjustment, downscaling and checking of daily gridded climate data.

A dataset is a long-form cube: one row per day and grid cell, one column per variable. Every operator
takes and returns DataFrames and triggers no action unless its docstring says so.
"""

"""Spark-native building blocks for a healthcare lakehouse.

Raw payloads are landed, de-identified, mapped to a clinical common data model,
quality-checked, linked, merged and summarised. Every operator takes DataFrames
and returns DataFrames made of built-in Spark expressions; the caller's session
decides where and how wide they run.
"""

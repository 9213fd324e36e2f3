"""Retail analytics operators for Spark DataFrames.

``sources``   reading, paging, exporting and the shop-table adapter
``functions`` column expressions and exact distributed statistics
``plans``     the star schema and multi-operator bundles
``operators`` one module per business area, DataFrame in, DataFrame out
``streaming`` the daily summary as an incremental job
"""

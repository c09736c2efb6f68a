"""goldleaf: medallion pipelines, gold tables, batch question answering and
scored evaluation as PySpark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing is collected
to the driver and no Python UDF is used.
"""

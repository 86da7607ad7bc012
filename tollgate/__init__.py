"""tollgate: model-lifecycle analytics as Spark DataFrame operators.

Every operator takes DataFrames (plus policy tables or typed settings) and
returns a DataFrame; nothing input-sized is collected to the driver.
"""

__version__ = "0.1.0"

"""The silver and gold layers as plans over DataFrames."""

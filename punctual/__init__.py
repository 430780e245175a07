"""Run-state and completion-deadline analytics on Spark DataFrames.

Every operator takes DataFrames plus an explicit ``as_of`` instant and returns a lazy DataFrame.
Nothing reads the clock, and no Python code runs per row.
"""

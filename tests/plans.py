def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()

"""Credit-risk feature engineering and model development as Spark DataFrame plans."""

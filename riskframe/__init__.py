"""riskframe: binary-risk modelling on tables, written as Spark DataFrame
expressions and Spark ML pipelines."""

__version__ = "0.1.0"

"""Training-data operators: jobs over a table of documents.

Every operator takes a DataFrame with an id and a text column and returns a
DataFrame; `entries` registers one query per operator.  Nothing else in the
library imports this package.
"""

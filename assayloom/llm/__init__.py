"""Training-data operators: text in, text decisions out. Nothing else in assayloom imports this package."""

"""assayloom: quality control and harmonisation of measurement matrices as Spark plans."""

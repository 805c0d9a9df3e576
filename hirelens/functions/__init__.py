"""Column functions: page parsing, row cleaning, text normalisation."""

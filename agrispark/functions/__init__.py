"""Column functions: constants of the data model and expressions shared by the operators."""

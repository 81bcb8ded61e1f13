"""Column helpers and distributed statistics shared by the stages."""

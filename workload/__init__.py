"""The library's steps run over the given tables, and the SQL each must equal."""

"""Plans built from the operators: tables in, one table out."""

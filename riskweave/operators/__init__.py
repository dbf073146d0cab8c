"""DataFrame -> DataFrame operators, grouped by reference stage."""

"""DataFrame -> DataFrame operators, independent of any particular relation."""

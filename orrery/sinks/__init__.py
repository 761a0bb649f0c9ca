"""Writers: catalog tables, JDBC tables, files and models."""

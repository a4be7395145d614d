"""Reading and writing: raw files, stored tables, quarantine, JDBC and catalogs."""

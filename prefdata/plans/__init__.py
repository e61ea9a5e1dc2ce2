"""The operators applied to the test tables, with the SQL that checks them."""

"""The registered queries and the SQL each is compared with."""

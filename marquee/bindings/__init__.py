"""The driver tables seen as event listings, the queries over them, and the SQL that checks them."""

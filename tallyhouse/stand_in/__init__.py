"""The driver's retail tables standing in for the banking tables, and the registered queries over them."""

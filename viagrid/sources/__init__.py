"""Reading landed files and event logs; writing tables and registering them."""

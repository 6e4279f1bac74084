"""Registered queries over the fixture tables, each with the SQL that must give the same rows."""

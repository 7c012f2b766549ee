"""Logical plans of the warehouse, the marts, the read views and the reports on them."""

"""The operators bound to tables: one query per operator, and its SQL counterpart."""

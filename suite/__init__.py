"""Registered queries: the library's operators over the shared test tables, each with its SQL counterpart."""

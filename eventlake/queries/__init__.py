"""Registered queries over the driver tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from eventlake.queries import activity, changes, delivery, operations, orders, streams

_MODULES = (orders, changes, activity, delivery, operations, streams)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}

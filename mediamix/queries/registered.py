"""All registered queries and the SQL they are checked against."""

from mediamix.queries import model, prepare, select

_MODULES = [prepare, select, model]
QUERIES = {name: query for module in _MODULES for name, query in module.Q.items()}
SQL = {name: text for module in _MODULES for name, text in module.S.items()}

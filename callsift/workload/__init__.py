"""Registered queries and the SQL that gives the same rows."""

from callsift.workload import answering, curation, labelling

PARTS = (curation, labelling, answering)
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
SQL = {name: text for part in PARTS for name, text in part.SQL.items()}

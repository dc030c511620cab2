"""Queries of this subpackage, and the SQL of those that SQL can express; tests hold the others against brute force."""

from __future__ import annotations

from tallymark.llm import queries
from tallymark.llm.oracles import ORACLES as ORACLES

QUERIES = {name: f for name, f in vars(queries).items() if name.startswith("op") and callable(f)}

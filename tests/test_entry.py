"""The entry module with and without the text operators."""

import ast
import importlib
import importlib.util
import pathlib

import __spark_entry__
from sportmart.plans.catalogue import QUERIES

ROOT = pathlib.Path(__spark_entry__.__file__).parent


def test_entry_without_the_text_operators(monkeypatch):
    find = importlib.util.find_spec
    hidden = ("sportmart.llm", "corpus_pipeline")
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in hidden else find(name, *a))
    entry = importlib.reload(__spark_entry__)
    assert entry.queries().keys() == QUERIES.keys() and entry.oracle_sql().keys() <= QUERIES.keys()
    monkeypatch.undo()
    assert importlib.reload(__spark_entry__).queries().keys() >= QUERIES.keys()


def test_nothing_else_imports_the_text_operators():
    for path in ROOT.glob("sportmart/**/*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else []
            names += [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in name or name == "corpus_pipeline" for name in names), path

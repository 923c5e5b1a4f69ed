"""Queries over whole tables against plain versions."""

from __future__ import annotations

from ledgerflow.plans.registry import QUERIES


def test_part_supplier_graph_has_all_links(spark, sf):
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r in spark.read.parquet(f"{sf}/lineitem.parquet").select("l_partkey", "l_suppkey").distinct().collect():
        a, b = sorted((find(r.l_partkey * 2), find(r.l_suppkey * 2 + 1)))
        parent[b] = a
    got = {r.node: r.component for r in QUERIES["part_supplier_components"](spark, sf).collect()}
    assert got == {n: find(n) for n in parent}

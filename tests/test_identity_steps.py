"""The two votes on identities read written steps, whatever made the raw identities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlens.plans import identity as I


def test_raw_identities_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def named(v):
        made.add(1)
        return v

    rows = [(f"r{i}", i % 3 or None, f"n{i % 4}" if i % 5 else None, 1 + i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "raw string, id_new int, name string, n int").withColumn("id_new", F.col("id_new").cast("decimal(38,0)"))
    out = I.resolve_identities(df.withColumn("name_new", named.asNondeterministic()("name")), ["raw"])
    got = {r["raw"]: (r["id_std"], r["name_std"]) for r in out.collect()}
    assert len(got) == 60 and made.value == 60

    # the same votes by hand
    def vote(pairs, skip=None):
        total = {}
        for (k, v), n in pairs.items():
            if skip is None or k != skip:
                total.setdefault(k, {})[v] = total.setdefault(k, {}).get(v, 0) + n
        return total

    unique = {}
    for _, i, name, n in rows:
        unique[i, name] = unique.get((i, name), 0) + n

    def winner(values, own, least):
        if len(values) < 2:
            return own
        best = min(values, key=lambda v: (-values[v], v is None, v if v is not None else ""))
        share = 100 * values[best] / sum(values.values())
        best = own if best is None else best
        return best if share > 50 or (len(values) > 2 and share > least) else own

    by_id = vote(unique, skip=1)
    names = {k: winner(by_id[k[0]], k[1], 8) if k[0] in by_id else k[1] for k in unique}
    # the second vote is among rows (name_std, id_new), each with its own weight
    pairs = {}
    for k, n in unique.items():
        pairs.setdefault(names[k], []).append((k[0], n))
    want = {}
    for raw, i, name, _ in rows:
        std = names[i, name]
        own = pairs[std]
        ids = {v for v, _ in own}
        best = min(own, key=lambda p: (-p[1], p[0] is None, p[0] or 0))
        share = 100 * best[1] / sum(n for _, n in own)
        clear = len(ids) > 1 and (share > 50 or (len(ids) > 2 and share > 4))
        want[raw] = (best[0] if clear and best[0] is not None else i, std)
    assert {k: (None if a is None else int(a), b) for k, (a, b) in got.items()} == want

"""Values per key as rows in order, against plain Python."""

import hashlib

from tessera.operators import panel as P


def test_a_groups_values_are_rows_in_order(spark):
    data = [(None if i % 7 == 0 else i % 3, (i * 37) % 200, None if i % 11 == 0 else f"t{i}", None if i % 5 == 0 else i / 4) for i in range(200)]
    df = spark.createDataFrame(data, "day int, id long, text string, score double")
    wanted = {}
    for day, key, text, score in sorted(data, key=lambda r: r[1]):
        wanted.setdefault(day, []).append((text, score))
    rows = [(d, i, t) for d, own in wanted.items() for i, (t, _) in enumerate(own, 1)]
    got = P.group_collect(df, "day", "text", ["id"])
    assert sorted(map(str, got.collect())) == sorted(f"Row(day={d}, position={i}, items={t!r})" for d, i, t in rows)

    items, means = P.group_score_mean(df, "day", "text", "score", ["id"])
    assert {(r.day, r.position, r.news, r.sentiment_score) for r in items.collect()} == {
        (d, i, t, x) for d, own in wanted.items() for i, (t, x) in enumerate(own, 1)}
    for r in means.collect():
        scores = [x for _, x in wanted[r.day] if x is not None]
        assert r.n_news == len(wanted[r.day]) and abs(r.mean_sentiment_score - sum(scores) / len(scores)) < 1e-9

    got = {r.day: r.md5 for r in P.ordered_digest(items, "day", "news", "|", "md5").collect()}
    assert got == {d: hashlib.md5("|".join(t for t, _ in own if t is not None).encode()).hexdigest() for d, own in wanted.items()}

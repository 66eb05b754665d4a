"""First-wins dedup: reference cases and a randomized check against a sequential loop."""

import random

from renown.operators.dedup import deduplicate, first_per_key, first_wins_ords

REC = "ord long, source string, title string, url string, domain string"


def _dedup(spark, rows):
    df = spark.createDataFrame(rows, REC)
    return sorted(r.ord for r in deduplicate(df).collect())


def test_keys_of_dropped_rows_are_not_remembered(spark):
    rows = [(0, "news", "Title One", "https://a/1", "a"),
            (1, "news", "Title One", "https://a/2", "a"),
            (2, "news", "Other", "https://a/2", "a")]
    assert _dedup(spark, rows) == [0, 2]


def test_canonical_url_variants_collapse(spark):
    rows = [(0, "news", "x1", "https://Site.com/a/?utm_source=t", "s"),
            (1, "news", "x2", "https://site.com/a", "s"),
            (2, "news", "x3", "https://site.com/a?b=1", "s")]
    assert _dedup(spark, rows) == [0, 2]


def test_title_domain_and_exclusions(spark):
    rows = [(0, "news", "Hello, World!", "https://a/1", "A.com"),
            (1, "gdelt", "hello world", "https://a/2", "a.com"),
            (2, "news", "hello world", "https://a/3", "b.com"),
            (3, "youtube_comments", "hello world", "https://a/4", "a.com"),
            (4, "wikitalk", "T", "https://w/talk#s1", "w"),
            (5, "wikitalk", "T", "https://w/talk#s2", "w")]
    assert _dedup(spark, rows) == [0, 2, 3, 4, 5]


def _sequential(rows):
    seen_u, seen_t, kept = set(), set(), []
    for o, u, t in sorted(rows):
        if u is not None and u in seen_u:
            continue
        if t is not None and t in seen_t:
            continue
        if u is not None:
            seen_u.add(u)
        if t is not None:
            seen_t.add(t)
        kept.append(o)
    return kept


def test_randomized_against_sequential(spark):
    rnd = random.Random(7)
    for trial in range(6):
        n = 120
        rows = []
        for i in range(n):
            u = None if rnd.random() < 0.1 else f"u{rnd.randrange(25)}"
            t = None if rnd.random() < 0.2 else f"t{rnd.randrange(25)}"
            rows.append((i * 3 + trial, u, t))
        df = spark.createDataFrame(rows, "ord long, _uk string, _tk string")
        got, rounds = first_wins_ords(df)
        assert sorted(r.ord for r in got.collect()) == _sequential(rows)
        assert rounds >= 1


def test_first_per_key_keeps_earliest_and_null_group(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (5, None), (4, "b")], "ord long, k string")
    assert sorted(r.ord for r in first_per_key(df, ["k"]).collect()) == [1, 2, 4]


def test_hot_key_third_of_rows(spark):
    """One url key holds a third of the rows; the answer still equals the sequential scan."""
    n = 3000
    rows = []
    for i in range(n):
        u = "hot" if i % 3 == 0 else f"u{i}"
        t = f"t{i % 97}" if i % 5 == 0 else None
        rows.append((i, u, t))
    df = spark.createDataFrame(rows, "ord long, _uk string, _tk string")
    got, rounds = first_wins_ords(df)
    assert sorted(r.ord for r in got.collect()) == _sequential(rows)


def test_one_article_stays_once_per_target(spark):
    rows = [(i, t, "news", "Title One", "https://a/1", "a.com") for i, t in enumerate(["A", "B", "A", None, None])]
    df = spark.createDataFrame(rows, "ord long, target string, source string, title string, url string, domain string")
    assert sorted(r.ord for r in deduplicate(df).collect()) == [0, 1, 3]


def test_null_keys_and_empty_input(spark):
    schema = "ord long, _uk string, _tk string"
    rows = [(i, None, f"t{i % 10}" if i % 2 else None) for i in range(200)]
    got, _ = first_wins_ords(spark.createDataFrame(rows, schema))
    assert sorted(r.ord for r in got.collect()) == _sequential(rows)
    assert first_wins_ords(spark.createDataFrame([], schema))[0].count() == 0

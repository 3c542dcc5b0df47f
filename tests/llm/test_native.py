"""URL rules, rule ledger and source mix: edge rows and brute force."""

from __future__ import annotations

import random
import re

import pytest

from dailyfacts.llm import rule_ledger, source_mix, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {
        j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)
    }
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    None, "", " \t\n", "one", "é ö  ü\x0bword", "# a | b\n# a | b\n\n# a | b",
    " ".join(f"w{i}" for i in range(30)),
    "a b c d e f g h " * 3, "x " * 50, "lead " + "p q r s t u v w " * 2 + "tail p q r s t u v w",
    "long " * 5000 + " ".join(map(str, range(3000))),
]


def test_measurements_match_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, n_words string")
    rows = {r.doc_id: r for r in rule_ledger.rule_ledger(docs).collect()}
    for i, text in enumerate(TEXTS[:-1]):
        row = rows[i]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == measured(text), text
    assert rows[len(TEXTS) - 1].n_repeat_words == 5000


def test_policies_filter_and_ablate(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(1, good, 5), (1, good, 5), (2, None, 6), (3, "aa bb cc dd ee ff gg hh " * 9, 7), (None, good, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _ledger long")
    kept = rule_ledger.keep_passing(docs)
    assert kept.columns == docs.columns
    assert sorted(r._ledger for r in kept.collect()) == [5, 5, 8]
    effects = {r.rule: r for r in rule_ledger.ablations(rule_ledger.rule_ledger(docs)).collect()}
    assert effects["short"].failed == 1 and effects["short"].kept == 3
    assert effects["repeated_words"].kept_without == 4
    base = rule_ledger.keep_passing(docs, rule_ledger.Policy("short only", ("short",)))
    assert base.count() == 4
    with pytest.raises(KeyError):
        rule_ledger.mask(rule_ledger.Policy("none", ("no such rule",)))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert rule_ledger.rule_ledger(docs).count() == 0
    assert rule_ledger.ablations(rule_ledger.rule_ledger(docs)).count() == len(rule_ledger.RULES)
    assert source_mix.mix(docs).count() == 0
    assert source_mix.mixed_documents(docs).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    mined = url_rules.mine_rules(url_rules.labelled_urls(pages, labels))
    assert url_rules.judge(pages, mined).count() == 0


def test_targets_match_a_stepwise_filling(spark):
    sizes = {"a": 100, "b": 2000, "c": 300, "d": 0, "e": 50}
    totals = spark.createDataFrame(
        [(f"={k}", k, v, 1) for k, v in sizes.items()] + [("", None, 400, 1)],
        "name string, source string, source_size long, n_docs long",
    )
    found = {r.source: r.target for r in source_mix.source_targets(totals).collect()}
    names = [*sorted(sizes), None]
    size = {**sizes, None: 400}
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    target, full = {}, set()
    while True:
        rest = 1.5 * sum(size.values()) - sum(2 * size[n] for n in full)
        free = [n for n in names if n not in full]
        target = {n: 2.0 * size[n] for n in full}
        target |= {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = {n for n in free if target[n] > 2 * size[n]}
        if not over:
            break
        full |= over
    assert found == pytest.approx(target)


def test_mix_takes_targets_and_agrees_with_itself(spark):
    rows = [(i, "w " * (i % 37), None if i % 11 == 0 else f"s{i % 4 if i % 3 else 0}", i) for i in range(600)]
    rows += [(None, "null key " * 3, "s1", 0), (5, "again", "s2", 0), (5, "again", "s2", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    mixed = [tuple(r) for r in source_mix.mix(docs, shards=5, blocks=40).select("doc_id", "size", "target", "taken", "source_size").collect()]
    assert len(mixed) == len(rows)
    assert all(taken <= 2 * size for _, size, _, taken, _ in mixed)
    taken = {}
    for _, _, target, t, whole in mixed:
        taken[target, whole] = taken.get((target, whole), 0) + t
    assert all(abs(t - target) <= 1 for (target, _), t in taken.items())
    again = source_mix.mix(docs.repartition(3), shards=5, blocks=40).select("doc_id", "size", "target", "taken", "source_size")
    key = lambda row: str(row)
    assert sorted(mixed, key=key) == sorted(map(tuple, again.collect()), key=key)
    copies = source_mix.mixed_documents(docs, shards=5, blocks=40)
    assert copies.columns == docs.columns
    total = sum(len(WORD.findall(r.text)) for r in copies.collect())
    assert total == sum(t for _, _, _, t, _ in mixed)


def test_tree_keeps_exact_quotas(spark):
    counts = spark.createDataFrame([("a", 40), ("b", 13), ("c", 1)], "name string, n long")
    dealt = source_mix.split_tree(counts, 5)
    assert dealt.count() == 54
    by_shard = {r.shard: r["count"] for r in dealt.groupBy("shard").count().collect()}
    assert set(by_shard) == set(range(5)) and max(by_shard.values()) - min(by_shard.values()) <= 2
    assert dealt.select("name", "nth").distinct().count() == 54


URLS = [
    None, "", "no scheme", "https://Example.COM/en/1", "http://www.example.com/en/x?y=1#z",
    "https://a.b.net/es/2", "https://net/fr/", "https://other.org", "ftp://badnet/es/1", "x://com?/en/", "https://com/",
]
FOUND = [
    ("", "", None), ("", "", None), ("", "", None), ("example.com", "/en/1", "example.com/en/"),
    ("www.example.com", "/en/x", "www.example.com/en/"), ("a.b.net", "/es/2", "net/es/"), ("net", "/fr/", "net/fr/"),
    ("other.org", "", None), ("badnet", "/es/1", None), ("com", "", None), ("com", "/", "com/"),
]


def test_listed_rules(spark):
    pages = spark.createDataFrame([(i, u, "q") for i, u in enumerate(URLS)] * 2, "page_id long, url string, verdict string")
    none = spark.createDataFrame([], "rule_id long, tokens array<string>")
    rows = url_rules.judge(pages, none).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        assert (r.host, r.path, r["rule"]) == FOUND[r.page_id]
        assert r.verdict == ("block" if r["rule"] and r["rule"] not in ("com/", "www.example.com/en/") else "allow")


def test_mined_rules_match_counting_all_sets(spark):
    from itertools import combinations

    urls, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        host = "spam" if bad and i % 8 else ["a", "b", "c"][i % 3]
        urls.append((i, f"http{'s' * (i % 2)}://{host}.org/{'x' if i % 5 else 'y'}/{i}"))
        labels.append((i, 0 if bad else 1, 0))
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labelled = url_rules.labelled_urls(pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rules = url_rules.mine_rules(labelled, least_pages=5).collect()
    rows = [(frozenset(r.tokens), r.bad) for r in labelled.collect()]
    bad_rows = [t for t, bad in rows if bad]
    sure = {}
    for s in {frozenset(c) for t in set(bad_rows) for n in range(1, len(t) + 1) for c in combinations(t, n)}:
        n_bad = sum(s <= t for t in bad_rows)
        n = sum(s <= t for t, _ in rows)
        if n_bad >= max(5, 0.01 * len(bad_rows)) and n_bad / n >= 0.5:
            sure[s] = n_bad / n
    expected = {s for s, c in sure.items() if not any(g < s and sure[g] >= c for g in sure)}
    assert {frozenset(r.tokens) for r in rules} == expected and frozenset(["h:spam"]) in expected
    mined = url_rules.mine_rules(labelled, least_pages=5)
    verdicts = {r.page_id: r.verdict for r in url_rules.judge(pages, mined).collect()}
    for i, url in urls:
        assert (verdicts[i] == "block") == ("spam" in url or any(s <= _tokens(url) for s in expected))


def test_rules_of_rare_bad_pages_are_proven_by_lift(spark):
    rng = random.Random(7)
    urls, labels = [], []
    for i in range(3000):
        host = f"h{i % 20}"
        # One page of twelve is bad, of one host two of five: far below a half.
        urls.append((i, f"https://{host}.org/p/{i}"))
        labels.append((i, int(rng.random() >= (0.4 if host == "h7" else 0.08)), 0))
    pages = spark.createDataFrame(urls, "page_id long, url string")
    schema = "doc_id long, quality int, toxic int"
    labelled = url_rules.labelled_urls(pages, spark.createDataFrame(labels, schema))
    found = url_rules.proven_rules(labelled, least_pages=5).collect()
    assert [r.tokens for r in found] == [["h:h7"]] and found[0].held_bad >= 0.2 * found[0].held_n > 1
    assert url_rules.mine_rules(labelled, least_pages=5).count() == 0
    verdicts = url_rules.judge(pages, url_rules.proven_rules(labelled, least_pages=5)).collect()
    assert {r.verdict == "block" for r in verdicts if "h7." in r.host} == {True}
    assert {r.verdict for r in verdicts if "h7." not in r.host} == {"allow"}
    # Labels that do not depend on the url, or none, give no rule.
    chance = spark.createDataFrame([(i, int(rng.random() >= 0.1), 0) for i in range(3000)], schema)
    assert url_rules.proven_rules(url_rules.labelled_urls(pages, chance), least_pages=5).count() == 0
    assert url_rules.proven_rules(url_rules.labelled_urls(pages, chance.limit(0))).count() == 0


def _tokens(url):
    scheme, rest = url.split("://")
    host, first, _ = rest.split("/")
    return {f"s:{scheme}", *[f"h:{x}" for x in host.split(".")], f"p:{first}", "p:#"}

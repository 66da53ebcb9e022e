"""Operators against plain renderings of their rules, and on tables without rows."""

import collections
from bisect import bisect_left, insort
from math import ceil, comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import packing, preference, quality, secrets, toxicity
from tallyhouse.llm.common import settings, table

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def plain_best_fit(counts, capacity):
    """Sequences that best fit by descending length opens, piece by piece."""
    rooms, opened = [], 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect_left(rooms, length)
            room = rooms.pop(at) if at < len(rooms) else capacity
            opened += room == capacity
            if room > length:
                insort(rooms, room - length)
    return opened


def test_sweeps_open_no_more_sequences_than_plain_best_fit():
    rng = np.random.default_rng(3)
    for _ in range(200):
        capacity = int(rng.integers(4, 200))
        counts = {int(n): int(rng.integers(1, 30)) for n in rng.integers(1, capacity + 1, rng.integers(1, 30))}
        filled, placed = collections.defaultdict(list), collections.Counter()
        for length, rank, number, first, offset in packing.sweep(counts, capacity):
            assert rank == placed[length]
            placed[length] += number
            for k in range(number):
                filled[first + k].append((offset, length))
        assert placed == counts
        for places in filled.values():
            ends = np.cumsum([n for _, n in sorted(places)])
            assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= capacity
        assert len(filled) <= plain_best_fit(counts, capacity)


def plain_levels(r):
    share = lambda a, b: min(1.0, a / max(b, 1))
    length = min(1.0, r["word_chars"] / max(r["n_words"], 1) / 50)
    of = {"symbols": share(r["n_symbols"], r["word_chars"]), "dup_lines": share(r["n_dup_lines"], r["n_lines"]), "repeats": share(r["n_repeat_words"], r["n_words"]), "long_words": length, "short_words": 1 - length}
    return {rule: (m, ceil(m * quality.GRID)) for rule, m in of.items()}


def plain_cutoffs(good, most_false, error):
    """Levels by stratum (None: the pool) and rule, good: levels of the good documents by stratum."""
    tests = (len(good) + 1) * quality.N_RULES
    chance = lambda k, n: sum(comb(n, i) * most_false**i * (1 - most_false) ** (n - i) for i in range(k + 1))
    false = lambda of, rule, level: sum(x[rule][1] > level for x in of)
    found = {}
    for stratum, of in {**good, None: [x for g in good.values() for x in g]}.items():
        for rule in of[0]:
            for level in range(quality.GRID - 1, -1, -1):
                k = false(of, rule, level)
                if k > most_false * len(of) or chance(k, len(of)) > error / tests:
                    break
                found[stratum, rule] = level
    for stratum, of in good.items():
        if (1 - most_false) ** len(of) > error / tests:  # too few to certify anything
            for rule in of[0]:
                near = [x for x in range(found.get((None, rule), quality.GRID), quality.GRID) if false(of, rule, x) <= most_false * len(of)]
                if near:
                    found[stratum, rule] = near[0]
    return found


@pytest.mark.parametrize("most_false", [0.02, 0.1])
def test_verdicts_follow_from_plain_cutoffs(spark, most_false):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    measured = {r["doc_id"]: r for r in rows(quality.measures(docs))}
    low = collections.defaultdict(lambda: 1)
    for r in rows(labels.where("doc_id is not null and quality is not null")):
        low[r["doc_id"]] = min(low[r["doc_id"]], r["quality"])
    good = collections.defaultdict(list)
    for doc, q in low.items():
        if q == 1 and doc in measured:
            good[measured[doc]["stratum"] or ""].append(plain_levels(measured[doc]))
    cut = plain_cutoffs(good, most_false, quality.ERROR)
    assert any(s is not None for s, _ in cut)
    rejected = 0
    for r in rows(quality.apply_rules(docs, labels, most_false=most_false)):
        of = measured[r["doc_id"]]
        stratum = of["stratum"] or ""
        at = lambda rule: cut.get((stratum if stratum in good else None, rule))  # noqa: B023, E731
        failed = {rule for rule, (m, _) in plain_levels(of).items() if at(rule) is not None and m > at(rule) / quality.GRID}
        assert set(r["failed"]) == failed and r["kept"] == (not r["base_failed"] and not failed)
        rejected += bool(failed)
    assert rejected


def test_tables_without_rows(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    none = docs.limit(0)
    assert rows(secrets.find_secrets(none)) == rows(secrets.redact(none)) == []
    model = toxicity.train(none, labels.limit(0))
    assert rows(toxicity.score(none, model)) == rows(toxicity.accepted(none, model)) == []
    assert not any(r["rejected"] for r in rows(toxicity.score(docs, model)))
    turns = table(spark, SMALL, "conversations").limit(0)
    assert rows(preference.preferences(preference.swapped_replies(turns))) == []


def test_columns_named_like_results_do_no_harm(spark):
    turns = table(spark, SMALL, "conversations")
    pairs = preference.swapped_replies(turns)
    plain = sorted(map(repr, rows(preference.preferences(pairs))))
    odd = pairs.withColumns({c: F.lit("x") for c in ("n", "a", "b", "prompt", "n_prompt_turns", "chosen_mask")})
    assert plain and sorted(map(repr, rows(preference.preferences(odd)))) == plain


def test_settings_are_put_back(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), settings(spark, {name: "4096"}):
        assert spark.conf.get(name) == "4096"
        1 / 0  # noqa: B018
    assert spark.conf.get(name) == before

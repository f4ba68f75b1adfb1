"""Secret scan on texts with very many matches, and its entropy windows against plain Python."""

import math
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from offerloom.llm import secret_scan as s


def hot_spans(text, base):
    """The windows of the definition, merged inside each string."""
    out = []
    for m in re.finditer(s.CANDIDATE, text):
        word = m[0]
        if not re.search("[0-9]", word) or re.search(s.ALLOWED.removeprefix("(?i)"), word, re.I):
            continue
        bits = lambda w: s.HEX_BITS if re.fullmatch("[0-9a-fA-F]+", w) else s.PLAIN_BITS if re.fullmatch("[A-Za-z0-9]+", w) else s.ANY_BITS
        spans = []
        for i in range(len(word) - s.WINDOW + 1):
            w = word[i:i + s.WINDOW]
            own = re.search("[0-9]", w) and re.search("[^0-9a-f]", w)
            entropy = -sum(n / s.WINDOW * math.log2(n / s.WINDOW) for n in Counter(w).values())
            if round(entropy, 6) >= bits(w if own else word):
                if spans and spans[-1][1] >= i:
                    spans[-1][1] = i + s.WINDOW
                else:
                    spans.append([i, i + s.WINDOW])
        out += [(m.start() + a, m.start() + b) for a, b in spans]
    return [(a, 3, b) for a, b in out if not any(x < b and a < y for x, _, y in base)]


def test_entropy_spans_are_the_definition(spark):
    import random
    rng = random.Random(3)
    alphabet = ["0123456789abcdef", "0123456789ABCDEF", "abcXYZ0123456789qrsTUV", "ab01+/_=-XY", "0123456789"]
    texts = [" ".join("".join(rng.choice(rng.choice(alphabet[:3]) if rng.random() < 0.1 else a) for _ in range(rng.randrange(10, 70)))
                      for a in rng.choices(alphabet, k=12)) + " é token=" + "k9" * rng.randrange(4, 9) for _ in range(40)]
    rows = s.scanned(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    hits = 0
    for r in rows:
        base = [tuple(x) for x in r["base"]]
        expected = hot_spans(r["text"], base)
        assert sorted([tuple(x) for x in r["spans"]]) == sorted(base + expected)
        hits += len(expected)
    assert hits > 20


def test_many_matches_in_one_text(spark):
    """Work grows with the matches, not with their square; pieces join without a gap."""
    hexes = [f"{i:016x}" for i in range(20_000)]
    mixed = [f"q8Zr2LkV9x{i:05d}Tn4WbY7c" if i % 2 else f"{i:016x}" for i in range(6_000)]
    for words in (hexes[:255], hexes[:256], hexes[:257], hexes, mixed):
        text = " ".join(words)
        began = time.time()
        r = s.scanned(spark.createDataFrame([(text,)], "text string")).first()
        assert time.time() - began < 60
        base = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]{16,}", text)]
        assert [tuple(x) for x in r["base"]] == base
    assert len(r["spans"]) == len(base) + 3000


def test_no_match_no_span(spark):
    rows = spark.createDataFrame([(None,), ("",), ("plain words",)], "text string")
    assert s.scanned(rows).where((F.size("base") > 0) | (F.size("spans") > 0)).count() == 0

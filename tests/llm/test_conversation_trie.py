"""The prefix trie against a dictionary of tuples."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from cardgrain.llm import convtrie
from cardgrain.llm.common import prepare

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, pos long"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
           "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).digest()


def plain(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        seq = tuple(own.get(donor, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].add(c)
        ends[seq].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * words
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
                  for p, m in members.items())


def rows_of(df):
    return sorted(tuple(-1 if v is None else v for v in (r[c] for c in COLUMNS)) for r in df.collect())


@pytest.fixture(scope="module")
def frame(spark):
    prepare(spark)
    return lambda rows, parts=3: spark.createDataFrame(
        [(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(parts)


def made(seed, convs, deep):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for t in range(rng.choice([1, 2, 3, 5, deep])):
            text = f"say {t} {rng.randrange(2)} " * (1 + t % 3) if t < deep // 2 else f"turn {t} {c % 3}"
            rows.append((c, t, "user" if t % 2 else "bot", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [2, 3, 8])
def test_trie_matches_plain_dictionary(frame, height):
    """With low bands the totals cross several levels of band roots."""
    rows = made(5, 60, 23)
    sequences = convtrie.share_openings(convtrie.slim_turns(frame(rows)))
    assert rows_of(convtrie.trie(sequences, height)) == plain(rows)


def test_missing_values_ties_and_repeats(frame):
    rows = [(20, 1, "a", "x y"), (20, None, None, "first"), (20, 1, "b", "x"), (20, 1, "b", "x"),
            (21, 0, "a", None), (22, 0, "a", ""), (23, 5, None, None), (None, 1, "a", "lost"), (-7, 0, "a", ""),
            (-20, 0, "a", "neg"), (43, 0, "a", "no donor"), (49, 0, "é", "\x00 \x0b x"),
            (60, 0, "a", "word " * 400_000), (61, 0, "a", "word " * 400_000)]
    got = rows_of(convtrie.shared_prefixes(frame(rows)))
    assert got == plain(rows)
    assert any(d == 0 and n == 10 for _, d, _, n, *_ in got)


def test_role_and_text_do_not_run_together(frame):
    rows = [(20, 0, "ab", "c"), (40, 0, "a", "bc")]
    assert len(rows_of(convtrie.shared_prefixes(frame(rows)))) == 3


def test_many_conversations_end_at_one_node(frame, monkeypatch):
    """Ids of one node over several packed rows and partitions; a parent of many children."""
    monkeypatch.setattr(convtrie, "CHUNK", 7)
    rows = [(c, t, "u", "same") for c in range(600) for t in range(2)]
    rows += [(1000 + c, t, "u", "same" if t < 2 else f"own {c}") for c in range(250) for t in range(5)]
    assert rows_of(convtrie.shared_prefixes(frame(rows, 5))) == plain(rows)


def test_no_conversations(frame):
    assert convtrie.shared_prefixes(frame([(1, 1, "a", "b")]).where("false")).count() == 0

from __future__ import annotations

import random
import re

import pytest
import xxhash

from textloom.llm.simhash import PigeonringConfig, drop_near_duplicates, simhash_near_duplicates
from tests.llm.conftest import texts


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_fingerprint(text, words=4):
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if not found:
        return 0
    runs = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(ids, linked):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if linked(i, j):
                parent[root(i)] = root(j)
    members = {}
    for i in range(len(ids)):
        members.setdefault(root(i), []).append(ids[i])
    return [min((m for m in members[root(i)] if m is not None), default=None) for i in range(len(ids))]


def near_copies(seed, n, changes):
    rng, out = random.Random(seed), []
    for text in texts(seed, n):
        out.append(text)
        for _ in range(rng.randrange(4)):
            words = text.split()
            for _ in range(changes):
                words[rng.randrange(len(words))] = f"new{rng.randrange(99)}"
            out.append(" ".join(words))
    return out


def expected(pairs):
    prints = [brute_fingerprint(t) for _, t in pairs]
    components = brute_components([i for i, _ in pairs], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    return sorted((repr(i), f"{p:016x}", repr(c)) for (i, _), p, c in zip(pairs, prints, components, strict=True))


def told(df):
    return sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in df.collect())


def test_against_brute_force(make_docs):
    found = near_copies(3, 60, 1) + ["one line"] * 30
    pairs = [(1000 - 3 * k, t) for k, t in enumerate(found)]
    assert told(simhash_near_duplicates(make_docs(pairs))) == expected(pairs)


def test_a_large_group_of_near_copies(make_docs):
    """Fingerprints around one, more than a small file holds, and a chain of links."""
    rng = random.Random(5)
    base = " ".join(f"b{i}" for i in range(300)).split()
    pairs = []
    for k in range(80):
        words = list(base)
        words[rng.randrange(300)] = f"x{k}"
        pairs.append((k, " ".join(words)))
    assert told(simhash_near_duplicates(make_docs(pairs))) == expected(pairs)


def test_awkward_rows(make_docs, awkward):
    assert told(simhash_near_duplicates(make_docs(awkward))) == expected(awkward)
    assert simhash_near_duplicates(make_docs([])).collect() == []


def test_every_pair_within_the_budget_shares_a_file():
    rng = random.Random(1)
    for config in (PigeonringConfig(), PigeonringConfig(budget=3, boxes=4, chain=3), PigeonringConfig(budget=4, boxes=6, chain=2)):
        edges = config.edges()
        patterns = [set(config.flips(s)) for s in range(config.boxes)]
        for _ in range(2000):
            differ = sum(1 << b for b in rng.sample(range(64), rng.randrange(config.budget + 1)))
            met = False
            for s in range(config.boxes):
                turned = (differ >> edges[s] | differ << (64 - edges[s])) & (2**64 - 1)
                met |= turned & ((1 << sum(config.width(s + i) for i in range(config.chain))) - 1) in patterns[s]
            assert met
    with pytest.raises(ValueError):
        PigeonringConfig(budget=5, boxes=5)


def test_one_of_each_group_stays(make_docs, awkward):
    def similar(a, b):
        a, b = (lowered(t).split() for t in (a, b))
        a, b = ({tuple(x[i : i + 5]) for i in range(max(1, len(x) - 4))} if x else set() for x in (a, b))
        return not a and not b or len(a & b) >= 0.8 * len(a | b)

    pairs = [(k, t) for k, t in enumerate(near_copies(8, 40, 1))]
    docs = make_docs(pairs)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    components = brute_components([i for i, _ in pairs], lambda i, j: similar(pairs[i][1], pairs[j][1]))
    stays, got = set(components), {r.doc_id for r in kept.collect()}
    assert stays <= got  # only links of similar texts count
    near = len(pairs) - len(stays)
    assert near > 20 and len(got - stays) <= 0.15 * near
    got = sorted(((r.doc_id, r.text) for r in drop_near_duplicates(make_docs(awkward)).collect()), key=repr)
    assert sorted(repr((i, None if t is None else t[:20])) for i, t in got) == sorted(
        repr((i, None if t is None else t[:20]))
        for i, t in [(1, None), (-9, "a b c d e"), (4, "one"), (4, "two other words here"), awkward[8], awkward[10], awkward[11]]
    )
    assert drop_near_duplicates(make_docs([])).collect() == []


def shingled(text, words=5):
    found = lowered(text).split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def stay_by_brute_force(pairs):
    sets = [shingled(t) for _, t in pairs]

    def similar(i, j):
        return len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])

    return set(brute_components([i for i, _ in pairs], similar))


def edited(rng, words):
    """A block appended, replaced, cut or put in front, up to what the similarity allows."""
    share = rng.uniform(0.05, 0.2)
    new = [f"new{rng.randrange(10**6)}" for _ in range(max(1, int(share * len(words))))]
    at, half = rng.randrange(len(words)), max(1, len(new) // 2)
    return rng.choice([words + new, new + words, words[: len(words) - len(new)], words[:at] + new[:half] + words[at + half :]])


def test_block_edits_are_found_without_allowance(make_docs):
    rng, pairs = random.Random(17), []
    for text in texts(18, 60, 3000):
        words = text.split() * rng.choice([1, 1, 1, 3])
        for variant in (words, edited(rng, words), edited(rng, words)):
            pairs.append((len(pairs), " ".join(variant)))
    stays = stay_by_brute_force(pairs)
    assert len(pairs) - len(stays) > 40
    assert {r.doc_id for r in drop_near_duplicates(make_docs(pairs)).collect()} == stays


def test_near_copies_among_dissimilar_texts_of_one_file(make_docs):
    """Texts of the same words in other orders have equal word fingerprints, so the links of a large file say little."""
    rng, words, pairs = random.Random(23), [f"t{i}" for i in range(200)], []
    for _ in range(30):
        order = rng.sample(words, len(words))
        pairs.append((len(pairs), " ".join(order)))
        if rng.random() < 0.5:
            order[rng.randrange(200)] = f"new{len(pairs)}"
            pairs.append((len(pairs), " ".join(order)))
    template = [f"f{i}" for i in range(200)]
    for k in range(25):
        filled = [f"fill{k}x{i}" if i % 25 == 0 else w for i, w in enumerate(template)]
        pairs.append((len(pairs), " ".join(filled)))
        if k % 2:
            pairs.append((len(pairs), " ".join([*filled, "tail"])))
    stays = stay_by_brute_force(pairs)
    assert 25 <= len(pairs) - len(stays) <= 40 and len(stays) == 55
    assert {r.doc_id for r in drop_near_duplicates(make_docs(pairs)).collect()} == stays

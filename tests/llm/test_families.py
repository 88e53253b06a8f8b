"""Families of different near copies: all links are found, without trying all pairs."""

import random

import pytest

from relayout.llm import jaccard
from test_operators import brute_components


def edited(rng, base, n, fresh, new=0.6):
    """``n`` words replaced: by new words (a part ``new`` of them), by words of a few, or dropped."""
    out = list(base)
    for _ in range(n):
        k = rng.randrange(len(out))
        kind = rng.random()
        if kind < new:
            fresh[0] += 1
            out[k] = f"new{fresh[0]}"
        elif kind < 0.85:
            out[k] = rng.choice(["this", "that", "those"])
        elif len(out) > 20:
            del out[k]
    return out


def families(seed):
    """A base with edited copies, copies of copies far from the base, chains, and a base that is not there itself."""
    rng, docs, fresh = random.Random(seed), [], [0]
    base = [f"b{i}" for i in range(rng.choice([50, 90]))]
    docs += [edited(rng, base, rng.choice([0, 1, 1, 2, 3, 4, 6]), fresh) for _ in range(60)]
    for _ in range(3):
        middle = edited(rng, base, rng.choice([5, 8]), fresh)
        docs += [edited(rng, middle, rng.choice([0, 1, 2, 3]), fresh) for _ in range(15)]
    link = edited(rng, base, 3, fresh)
    for _ in range(20):
        link = edited(rng, link, rng.choice([1, 2]), fresh)
        docs.append(link)
    hidden = [f"h{i}" for i in range(70)]
    docs += [edited(rng, hidden, rng.choice([2, 3, 4]), fresh) for _ in range(40)]
    docs += [base[:30] + [f"x{k}y{j}" for j in range(25)] for k in range(10)]
    rng.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize("seed,words,similar", [(1, 4, (85, 100)), (2, 5, (80, 100)), (3, 1, (85, 100))])
def test_families_brute_force(spark, seed, words, similar):
    docs = families(seed)
    got = jaccard.similar_components(spark.createDataFrame(docs, "doc_id long, text string"), words=words, similar=similar).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs, words, *similar)


def test_members_edited_by_chance_are_not_paired(spark, monkeypatch):
    """A family in which hardly any two are similar: members meet the pivot, and few of them each other."""
    rng, fresh = random.Random(5), [0]
    base = [f"b{i}" for i in range(150)]
    docs = [(0, " ".join(base))] + [(k, " ".join(edited(rng, base, rng.choice([1, 2, 3, 4, 5]), fresh, 1.0))) for k in range(1, 400)]
    counted = {}
    plain = jaccard.stage

    def counting(df, name):
        out = plain(df, name)
        counted[name] = out.count()
        return out

    monkeypatch.setattr(jaccard, "stage", counting)
    got = jaccard.similar_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(docs)
    assert counted["met"] < 8 * len(docs) and counted["open_pairs"] < 8 * len(docs)

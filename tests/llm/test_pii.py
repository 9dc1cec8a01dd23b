import itertools
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentilake.llm import pii
from tests.llm.helpers import edge_documents, edge_rows, empty_documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def base(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


PARTS = st.sampled_from(["a@b.c", "@", ".", "x.y", "1.2.3.4", "12", "300.1.1.1", "+1 (017) 555-7713", "4111 1111 1111 1111", "-", " ",
                         "é", "+", "007.1.2.3.4.5.6.7", "a@b@c.d", "_%", "4111111111111111", "😀", "a@b.c.d-e"])


@settings(max_examples=600, deadline=None)
@given(st.lists(PARTS, max_size=9).map("".join))
def test_base_spans_match_brute_force(text):
    assert pii.base_spans(text) == base(text)


def test_dynamic_program_finds_the_best_labelling():
    rng = np.random.default_rng(3)
    for text in ("call 555-123-4567 now", "a@b.io 1.2.3.4", "x (at) y.com 12345678"):
        weights = rng.normal(size=len(pii.KINDS) * pii.WIDTH)
        tokens, ends = pii.segments(text)
        flat = [s for group in ends for s in group]
        assert len(flat) < 60
        scored = [(s, sum(weights[f] for f in s[3])) for s in flat]
        best = 0.0
        for n in (1, 2, 3):
            for chosen in itertools.combinations(scored, n):
                cut = sorted((s[0], s[2]) for s, _ in chosen)
                if all(a[1] <= b[0] for a, b in zip(cut, cut[1:])):
                    best = max(best, sum(x for _, x in chosen))
        at = {(tokens[s[0]][0], s[1], tokens[s[2] - 1][1]): x for s, x in scored}
        assert sum(at[s] for s in pii.best_spans(text, weights)) == pytest.approx(best)


def test_gradient_matches_differences():
    text, truth = "mail a@b.io or 555-123-4567", {(5, 0, 11), (15, 3, 27)}
    lattice, w = pii.segments(text), np.random.default_rng(1).normal(size=len(pii.KINDS) * pii.WIDTH)
    _, slope = pii.gradient(lattice, truth, w)
    for k in np.flatnonzero(slope)[:12]:
        step = np.zeros(len(w))
        step[k] = 1e-5
        want = (pii.gradient(lattice, truth, w + step)[0] - pii.gradient(lattice, truth, w - step)[0]) / 2e-5
        assert slope[k] == pytest.approx(want, abs=1e-4)


def test_held_out_spans():
    weights, right, found, true = pii.trained_weights(), 0, 0, 0
    for text, truth in pii.training_lines(80, 77):
        got = set(pii.best_spans(text, weights))
        right, found, true = right + len(got & truth), found + len(got), true + len(truth)
    assert right / found > 0.8 and right / true > 0.75


def test_edge_rows(spark):
    rows = edge_rows() + [(600, "é ann@mail.example.com, +1 (017) 555-7713; 10.0.0.1 4111 1111 1111 1111", "en", "s", 1),
                          (601, "write to ann (at) corp.org or call (212) 555-0199", "en", "s", 1), (602, "1" * 50_000 + "@" * 2000, None, None, None)]
    plain = {r[1]: base(r[1]) if r[1] and len(r[1]) < 40_000 else [] for r in rows}
    got = pii.find_personal_data(edge_documents(spark, rows)).collect()
    assert Counter((r["doc_id"], *(r[f"n_{k}"] for k in pii.KINDS)) for r in got) == Counter(
        (r[0], *(sum(k == kind for _, k, _ in plain[r[1]]) for kind in range(4))) for r in rows)
    by_id = {r["doc_id"]: r for r in got}
    assert set(pii.written(base(rows[-3][1])).split(",")) <= set(by_id[600]["spans"].split(","))
    assert by_id[601]["n_added"] == 2
    assert pii.find_personal_data(empty_documents(spark)).count() == 0

import hashlib
from collections import Counter

import pytest

from skyledger.llm import fingerprints
from tests.llm import odd


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cut(sentence):
    """Pieces of a sentence, by hand: the first cut after 17 to 64 characters, else 64 of them."""
    out = []
    while len(sentence) > 64 or (out and sentence):
        size = min(64, len(sentence))
        for i in range(16, min(63, len(sentence))):
            if sentence[i : i + 2] in [f"{c} " for c in "dnrty!?;:,"] or sentence[i] in "。！？":
                size = i + (1 if sentence[i] in "。！？" else 2)
                break
        out.append(sentence[:size])
        sentence = sentence[size:]
    return out or [sentence]


def parts(text):
    return [[[cut(x) for x in p.split(". ")] for p in s.split("\n")] for s in text.split("\n\n")]


def hashed(node):
    return sha(node) if isinstance(node, str) else sha(",".join(map(hashed, node)))


def root_and_nodes(text):
    found = parts(text)
    return hashed(found), Counter(y for s in found for p in s for x in p for y in x)


def weight(leaves):
    return sum(n * (len(leaf) + 1) for leaf, n in leaves.items())


def like(a, b):
    return 1.0 if a[0] == b[0] else weight(a[1] & b[1]) / weight(a[1] | b[1])


def brute(rows):
    out = {}
    for i, (doc, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        size = len(text) // 4
        edited = text[: len(text) - size] + following[:size]
        own, changed = root_and_nodes(text), root_and_nodes(edited)
        out[doc, text] = (
            doc, len(text), sha(edited), own[0], changed[0], like(own, changed), like(own, root_and_nodes(following)),
        )
    return out


def check(docs):
    given = docs.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS h").collect()
    order = sorted({(r.doc_id is not None, r.doc_id or 0, r.h, r.doc_id, r.text) for r in given})
    expected = brute([(o[3], o[4]) for o in order])
    found = sorted(map(tuple, fingerprints.edits(docs).collect()), key=str)
    assert found == sorted((expected[r.doc_id, r.text] for r in given), key=str)


def test_fixture_equals_brute_force(spark):
    check(odd.fixture_documents(spark))


def test_odd_rows(spark):
    check(odd.documents(spark))


def test_one_document_follows_itself(spark):
    check(odd.documents(spark, [(3, "One. Two. Three. Four")]))


def test_empty(spark):
    assert fingerprints.edits(odd.documents(spark, [])).count() == 0


def differing(a, b, above=(), level=0):
    n = min(len(a), len(b))
    start = next((i for i in range(n) if a[i] != b[i]), n)
    end = next((i for i in range(n - start) if a[-1 - i] != b[-1 - i]), n - start)
    left, right = len(a) - start - end, len(b) - start - end
    if level == 3 or left != right:
        return [((*above, start), left, right)]
    opened = [i for i in range(start, start + left) if a[i] != b[i]]
    return [x for i in opened for x in differing(a[i], b[i], (*above, i), level + 1)]


LONG = "\n\n".join("\n".join(f"{odd.prose(i * 7 + j, 9)}. {odd.prose(i * 7 + j + 3, 60)}" for j in range(4)) for i in range(5))


@pytest.mark.parametrize(
    ("change", "paths"),
    [
        (lambda t: t, set()),
        (lambda t: t.replace(odd.prose(2 * 7 + 1, 9), "new words"), {(2, 1, 0, 0)}),
        (lambda t: "new " + t + " new", None),
        (lambda t: t.replace("\n\n", "\n\nAdded.\n\n", 1), {(1,)}),
        (lambda t: "\n".join(line for i, line in enumerate(t.split("\n")) if i != 6), {(1, 1)}),
        (lambda t: t[: len(t) // 2], None),
        (lambda t: "", None),
        (lambda t: None, None),
    ],
)
def test_differing_branches_locate_the_edits(spark, change, paths):
    left = fingerprints.with_tree(odd.documents(spark, [(1, LONG)]), "left").select("doc_id", "n", "left")
    right = fingerprints.with_tree(odd.documents(spark, [(1, change(LONG))]), "right").select("doc_id", "right")
    found = fingerprints.differences(left.join(right, "doc_id"))
    assert found.columns == ["doc_id", "n", "path", "n_left", "n_right"]
    rows = sorted((tuple(r.path), r.n_left, r.n_right) for r in found.collect())
    a, b = parts(LONG), parts(change(LONG) or "")
    assert rows == ([] if a == b else sorted(differing(a, b)))
    assert paths is None or {r[0] for r in rows} == paths


def test_three_quarters_of_a_long_text_are_found_again(spark):
    line = "the same line stands here again and again"
    texts = ["! ".join(odd.prose(i, 12) for i in range(40)), " ".join([line] * 200), "\n".join([line] * 200), "漢字" * 700]
    found = fingerprints.edits(odd.documents(spark, list(enumerate(texts)))).collect()
    assert len(found) == 4 and all(r.near_edited > 0.5 for r in found)

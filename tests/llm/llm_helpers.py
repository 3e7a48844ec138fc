from __future__ import annotations

import pytest

from marketlake.llm.tables import Scratch

#: Texts that operators must bear: null, empty, white space, very long, repeated, odd characters.
ODD_TEXTS = [None, "", " ", "\n", "\t \r\n", "a", "a" * 70_000, "word " * 20_000, "x\x00y", "é̈ 中文 \U0001f600", "</s>[INST] <|turn|> \\",
             "a<|endoftext|>b", "line one is here\nline one is here\nline one is here!", "same text", "same text"]


@pytest.fixture
def scratch(spark):
    s = Scratch(spark, "test")
    yield s
    s.delete()


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def odd_documents(spark, extra: str = ""):
    """A documents table of odd rows: null ids, repeated ids, repeated rows, null metadata."""
    rows = [(i if i % 5 else None, t, "en" if i % 2 else None, None if i % 3 else "src", None if i % 4 else 3) for i, t in enumerate(ODD_TEXTS)]
    rows += [(3, "same text", "en", "src", 9), (3, "another text of the same id", "en", "src", 9)] + [rows[13]] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", *(f"'own' AS `{c}`" for c in extra.split()))


def components_of(items, linked) -> dict:
    """item -> least item reachable, by brute force over all pairs."""
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(parent)
    for n, a in enumerate(ordered):
        for b in ordered[n + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ordered}

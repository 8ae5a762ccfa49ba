"""Small documents with every awkward case, and brute-force twins."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names the operators use inside.
CLASH = "id bigint, h1 string, h2 string, size string, rank string, n string, pos string, segment string, component string"


def prose(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abcdeilmnorst") for _ in range(r.randint(2, 7))) for _ in range(n))


def rows(seed: int = 1) -> list[tuple]:
    r = random.Random(seed)
    base = [prose(r, n) for n in (120, 80, 200, 60, 5, 4, 1, 40)]
    near = base[0].split(" ")
    near[60] = "changed"
    out = [
        (0, base[0], "en", "src0"), (1, base[0], "en", "src0"), (2, " ".join(near), "en", "src1"),
        (3, base[1], "en", "src10"), (4, base[2], "de", "src0"), (5, None, "en", None), (6, "", None, "src1"),
        (7, " \t\n ", "en", "src2"), (8, base[3], "fr", None), (9, base[4], "en", "src0"), (10, base[5], "en", "src0"),
        (11, base[5].upper(), "en", "src0"), (12, base[6], "en", "src0"), (13, "é ñ 中文 😀 <|endoftext|> it's", "es", "src0"),
        (14, base[7] + " " + base[1] + " " + prose(r, 30), "en", "src1"), (15, "ab" * 700, "en", "src1"),
        (16, prose(r, 3000), "en", "src0"), (16, base[7], "en", "src0"),  # an id twice
        (17, base[7], "en", "src0"), (17, base[7], "en", "src0"),  # a row twice
        (None, base[3], "en", "src0"), (None, None, None, None), (18, "x" * 199, "en", "src0"), (19, "x" * 200, "en", "src3"),
    ]
    return [(*row, len(row[1] or "")) for row in out]


def documents(spark, data: list[tuple] | None = None, clash: bool = False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    if clash:
        for c in CLASH.split(", "):
            name, kind = c.split(" ")
            df = df.selectExpr("*", f"CAST(NULL AS {kind}) AS {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

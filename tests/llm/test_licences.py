"""Licence texts in all widths and dress, by the query and by its SQL twin."""

import textwrap
from pathlib import Path

import duckdb
import pytest

from sensitext.llm.licences import DIGESTS, LICENCES, TITLES, licence_scan
from sensitext.llm.sql import LICENCE_SCAN

COMMON = Path("/usr/share/common-licenses")
MARKS = ("", "# ", "// ", " * ", "    ")


def wrapped(text, width, mark=""):
    """Paragraphs of a text, wrapped anew."""
    paragraphs = [" ".join(p.split()) for p in text.split("\n\n")]
    lines = []
    for p in paragraphs:
        lines += [*textwrap.wrap(p, width, break_long_words=False, break_on_hyphens=False), ""]
    return "\n".join(mark + line for line in lines)


def both(spark, texts):
    """Licences by the query, once it agrees with its twin."""
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    columns = ["doc_id", "digest", "license", "n_notices", "notices"]
    ours = sorted(tuple(r) for r in licence_scan(frame).select(columns).collect())
    con = duckdb.connect()
    con.register("given", frame.toPandas())
    con.execute("CREATE VIEW documents AS SELECT * FROM given")
    theirs = sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({LICENCE_SCAN})").fetchall())
    assert ours == theirs
    return [r[2] for r in ours]


@pytest.mark.parametrize("name", sorted(LICENCES))
def test_short_licences_at_every_width(spark, name):
    notices = ["", "Copyright (c) 2020 A. Author\n\n", "Copyright 1999-2024 The Authors.\nAll rights reserved.\n\n"]
    texts = []
    for width in range(40, 121):
        title = ("", *TITLES[name])[width % (len(TITLES[name]) + 1)]
        head = f"{title}\n\n{notices[width % 3]}" if title else notices[width % 3]
        mark = MARKS[width % len(MARKS)]
        texts.append("\n".join(mark + x for x in head.splitlines()) + "\n" + wrapped(LICENCES[name], width, mark))
    assert set(both(spark, texts)) == {name}


@pytest.mark.skipif(not COMMON.is_dir(), reason="no folder of licence texts")
@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-3", "MPL-2.0"])
def test_long_licences_at_every_width(spark, name):
    text = (COMMON / name).read_text()
    wanted = {"GPL-3": "GPL-3.0"}.get(name, name)
    assert wanted in DIGESTS.values()
    texts = ["\n".join(mark + line for line in text.splitlines()) for mark in MARKS]
    if name == "Apache-2.0":
        texts += [wrapped(text, w, MARKS[w % len(MARKS)]) for w in range(40, 121)]
    assert set(both(spark, [*texts, text, text.upper()])) == {wanted}


def test_only_notices_are_dropped(spark):
    body = LICENCES["MIT"]
    near = [
        body.replace("free of charge", "for a fee"),
        body + "\ncopyright holders may add a line",
        body + "\n(c) a clause of a list",
        "copyright 2020 x " + body,
    ]
    assert both(spark, [body, *near]) == ["MIT", None, None, None, None]
    dressed = [
        "© 2021 Somebody\n" + body,
        "/* Copyright © Somebody */\n" + body,
        "Copyright <YEAR> <COPYRIGHT HOLDER>\n" + body,
        "(c) Copyright 2001 by Somebody\n(C) 2002 Else\n" + body,
    ]
    assert both(spark, dressed) == ["MIT"] * 4

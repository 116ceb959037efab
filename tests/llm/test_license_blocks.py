import textwrap

import pytest

from snapmart.llm import licenses

LINES = {texts[0]: name for name, texts in licenses.TEMPLATES.items()}


def confirmed(block):
    return [r[0] for r in licenses.matches(block) if r[8]]


@pytest.mark.parametrize("one", LINES)
@pytest.mark.parametrize("other", LINES)
def test_two_notices_in_one_line(one, other):
    assert set(confirmed(f"{one} {other}")) == {LINES[one], LINES[other]}


def test_all_notices_in_one_line():
    found = confirmed("See below. " + " And also: ".join(LINES))
    assert sorted(found) == sorted(LINES.values())


def test_nothing_confirmed_gives_one_row():
    assert len(licenses.matches("the license of this car was old")) == 1 and licenses.matches(" ") == []


@pytest.mark.parametrize("width", [24, 40, 72])
@pytest.mark.parametrize("text, name", [(t, n) for n, texts in licenses.TEMPLATES.items() for t in texts])
def test_wrapped_notices(text, name, width):
    lines = ["# " + line for line in textwrap.wrap(text, width)]
    page = "\n".join(["Some words of the file.", *lines, "And more of them follow."])
    rows = [row for _, line, before, after in licenses.cue_lines(page)
            for row, _ in licenses._in_line(line, before, after)]
    assert name in [r[0] for r in rows if r[8]]


def test_reserved_rights(spark):
    rows = licenses.scan(spark.createDataFrame(
        [(1, "some prose\nAll rights reserved."), (2, "All rights\nreserved."), (3, "all rights\n\nwere kept")],
        "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.block_no, r.license, r.confirmed) for r in rows) == [
        (1, 1, "All-Rights-Reserved", True), (2, 0, "All-Rights-Reserved", True)]


def names_in(text):
    return {r[0] for r in licenses.matches(text) if r[8]}


def test_versions_and_denials():
    for text in ("Licensed under the Apache License, Version 1.1.", "Not licensed under CC BY 4.0.",
                 "This is not licensed under CC BY 4.0", "All rights reserved are listed.", "Licensed under CC BY 3.0.",
                 "Licensed under the GNU Lesser General Public License, version 2.1.",
                 "This work is never licensed under the GNU General Public License, version 3."):
        assert names_in(text) == set(), text
    assert names_in("(c) 2020. All rights reserved.") == {"All-Rights-Reserved"} == names_in("All rights reserved")


def test_every_wording_is_confirmed_wrapped_or_not(spark):
    """Whole table: each wording alone, wrapped at every width, and joined with each other one."""
    docs, want = [], {}
    short = {name: min(texts, key=len) for name, texts in licenses.TEMPLATES.items()}
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            for width in (25, 60, 10_000):
                want[len(docs)] = {name}
                docs.append((len(docs), "Before.\n\n" + textwrap.fill(text, width, break_on_hyphens=False) + "\n\nAfter it"))
        for other, second in short.items():
            if other != name:
                want[len(docs)] = {name, other}
                docs.append((len(docs), f"{short[name]} {second}"))
    got = {}
    for r in licenses.confirmed_licenses(spark.createDataFrame(docs, "doc_id bigint, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert {d: (got.get(d), want[d], docs[d][1]) for d in want if got.get(d) != want[d]} == {}

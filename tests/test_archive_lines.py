"""Lines and records of archives, piece by piece, against plain loops."""

from __future__ import annotations

import random
import time

import pytest
from test_archives import make_zip

from skyledger.sources import archives


def plain_records(text: str, most: int) -> list[tuple[str, bool]]:
    """Records as their fields are read one character after the other."""
    lines = text.split("\n")
    lines = [x + "\n" for x in lines[:-1]] + [x for x in lines[-1:] if x]

    def closed(record: str) -> bool:
        at, n = 0, len(record)
        while True:
            if at < n and record[at] == '"':
                at += 1
                while True:
                    at = record.find('"', at)
                    if at < 0:
                        return False
                    if record[at + 1:at + 2] != '"':
                        break
                    at += 2
                at += 1
                while at < n and record[at] in " \t":
                    at += 1
            else:
                while at < n and record[at] != ",":
                    at += 1
            if at == n:
                return True
            if record[at] != ",":
                return False
            at += 1

    found, i = [], 0
    while i < len(lines):
        if not lines[i].rstrip("\r\n").strip():
            i += 1
            continue
        for k in range(i + 1, min(i + most, len(lines)) + 1):
            record = "".join(lines[i:k]).rstrip("\r\n")
            if (k == i + 1 or '"' in lines[k - 1]) and closed(record):
                found.append((record, True))
                i = k
                break
        else:
            found.append((lines[i].rstrip("\r\n"), False))
            i += 1
    return found


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_records_and_lines_of_random_text(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(archives, "CHUNK", chunk)
    pick = random.Random(chunk)
    texts = {
        f"{i}.csv": "".join(pick.choices(['"', ",", "\n", "\r\n", "a", " ", '""', '","', "é", " ", "\x1c", "\t"],
                                         [6, 3, 5, 1, 4, 2, 2, 3, 1, 1, 1, 1], k=pick.randint(0, 300)))
        for i in range(60)
    }
    make_zip(tmp_path / "a.zip", texts)
    zips = archives.read_archives(spark, str(tmp_path))
    got = sorted((r.member, r.record, r.closed) for r in archives.unpack_records(zips, 3, 5).collect())
    assert got == sorted((name, *x) for name, text in texts.items() for x in plain_records(text, 5))
    lines = sorted((r.member, r.line) for r in archives.unpack_lines(zips, 3).collect())
    assert lines == sorted(
        (name, x.rstrip("\r\n")) for name, text in texts.items()
        for x in text.split("\n")[:None if text and not text.endswith("\n") else -1])


def test_bytes_that_are_no_text(spark, tmp_path):
    content = b"a\xff,b\n\xe2\x82\n\xe2\x82\xacx,\xf0\x9f\n\n tail\xc3"
    make_zip(tmp_path / "a.zip", {"a.csv": content})
    lines = sorted(r.line for r in archives.unpack_lines(archives.read_archives(spark, str(tmp_path))).collect())
    assert lines == sorted(content.decode("utf-8", "replace").split("\n"))


def test_broken_records_cost_little_more_than_good_ones(spark, tmp_path):
    """A record that no further line can close is not tried with each of them."""
    seconds = {}
    for kind, begin in (("good", '"x",'), ("bad", '"x" "')):
        folder = tmp_path / kind
        folder.mkdir()
        make_zip(folder / "a.zip", {"a.csv": "".join(f"{begin}{i},{'y' * 40_000}\n" for i in range(1500))})
        found = archives.unpack_records(archives.read_archives(spark, str(folder)))
        began = time.perf_counter()
        assert found.where(f"closed = {kind == 'good'}").count() == 1500
        seconds[kind] = time.perf_counter() - began
    assert seconds["bad"] < 3 * seconds["good"] + 3

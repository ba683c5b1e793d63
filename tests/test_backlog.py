"""The stream of landed pages lists its area once for a backlog."""

import json
import os

from ledgerflow.sources import plugin


def test_a_backlog_is_listed_once(spark, tmp_path, monkeypatch):
    """F2: every micro-batch listed the whole landing area, twice."""
    for n in range(30):
        (tmp_path / f"part-{n}.json").write_text("[1]")
        os.utime(tmp_path / f"part-{n}.json", ns=(n * 10**9, n * 10**9))
    listings = []
    whole = plugin.Landing.pages
    monkeypatch.setattr(plugin.Landing, "pages", lambda self, days=None: listings.append(1) or whole(self, days))
    options = {"path": str(tmp_path), "files_per_batch": "4"}
    stream = plugin.PagesStream(options)

    def drain(stream, start):
        read = []
        while (end := stream.latestOffset()) != start:
            batch = [p.path for g in stream.partitions(start, end) for p in g.pages]
            assert 0 < len(batch) <= 4
            read, start = read + batch, end
        return read, start

    read, start = drain(stream, stream.initialOffset())
    assert [int(p.rsplit("-", 1)[1][:-5]) for p in read] == list(range(30))
    assert len(listings) == 2  # the backlog, and that nothing is behind it
    (tmp_path / "part-99.json").write_text("[1]")
    assert [p.rsplit("/", 1)[1] for p in drain(stream, start)[0]] == ["part-99.json"]
    # a restart plans a batch again that it has not listed itself
    again = plugin.PagesStream(options)
    planned = again.partitions({"changed": 9 * 10**9, "path": read[9]}, {"changed": 13 * 10**9, "path": read[13]})
    assert [p.path for g in planned for p in g.pages] == read[10:14]
    assert again.latestOffset()["path"] == read[17]

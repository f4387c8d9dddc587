"""The jobs from their command lines, one after the other on a database file."""

from __future__ import annotations

import json
import sqlite3
from pathlib import Path

import pytest

from tessera.plans import jobs

COLUMNS = "content_id TEXT PRIMARY KEY, newsletter_id INTEGER, source_key TEXT, content_date TEXT, title TEXT, author TEXT, url TEXT, content_md TEXT, scrape_status TEXT, fetch_tier TEXT, fetch_attempts INTEGER, vector_status TEXT, stored_at TEXT"
SETTINGS = {"index_strategies": {"small": {"collection_name": "leaves", "chunking": "fixed", "embedding_model": "hashing"}}, "eval_combos": ["leaves__cosine", "trees__cosine"]}


@pytest.fixture
def database(tmp_path):
    con = sqlite3.connect(tmp_path / "raw.db")
    con.execute(f"CREATE TABLE contents ({COLUMNS})")
    texts = {"a": "maple leaves turn red in autumn " * 5, "b": "granite and basalt are rocks " * 5, "c": "short", "d": None}
    con.executemany("INSERT INTO contents (content_id, source_key, title, content_md) VALUES (?, 's', 't', ?)", texts.items())
    con.commit()
    con.close()
    (tmp_path / "s.json").write_text(json.dumps(SETTINGS))
    (tmp_path / "q.json").write_text(json.dumps({"version": "v1", "queries": [{"query": "red maple leaves", "expected_content_ids": ["a"], "category": "plants"}]}))
    return tmp_path


def test_index_then_evaluate(spark, database, capsys):
    store = ["--store", f"{database}/store", "--config", f"{database}/s.json"]
    done = jobs.main(["index", "--contents", f"{database}/raw.db", "--strategy", "small", "--errors", *store])
    assert done == {"strategy": "small", "collection": "leaves", "chunk_count": 2, "errors": 0}
    assert json.loads(capsys.readouterr().out) == done
    assert jobs.main(["index", "--contents", f"{database}/raw.db", "--strategy", "small", *store])["chunk_count"] == 2
    done = jobs.main(["evaluate", "--queries", f"{database}/q.json", "--out", f"{database}/out", "--lone", "1", *store])
    made = json.loads(Path(done["report"][0]).read_text())
    assert done["missing"] == ["trees"] and made["query_set_version"] == "v1"
    assert made["combos"]["leaves__cosine"]["by_category"]["plants"]["mrr"] == 1 and made["combos"]["trees__cosine"]["status"] == "not_found"


def test_backup_then_retention(spark, database):
    for day in ("2020-01-01T00-00-00Z", "2020-01-02T00-00-00Z"):
        (database / "to" / day).mkdir(parents=True)
    done = jobs.main(["backup", "--source", str(database), "--to", f"{database}/to", "--keep", "2", "raw.db", "none.db"])
    assert (done["ok"], done["not_found"], done["removed"]) == (1, 1, ["2020-01-01T00-00-00Z"]) and done["total_bytes"] > 0


def test_arguments(database):
    for bad in (["index", "--store", "s"], ["backup", "--source", "a", "--to", "b"], []):
        with pytest.raises(SystemExit):
            jobs.parse(bad)
    assert jobs.parse(["evaluate", "--queries", "q", "--store", "s", "--out", "o"]).settings is jobs.config.DEFAULT

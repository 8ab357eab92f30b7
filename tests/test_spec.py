import pytest

from strandflow.spec import SpecError, TableSpec, is_loopback, load, parse, secret

GOOD = """
[source]
url = "mysql://reader@127.0.0.1:3306/shop"
server_id = 7
[search]
host = "http://localhost:7700"
[[tables]]
table = "products"
index = "products"
primary_key = "id"
fields = ["id", "name"]
"""


def with_table(**more):
    base = dict(table="products", index="products", primary_key="id", fields=("id", "name"))
    return TableSpec(**(base | more))


def test_defaults():
    spec = parse(GOOD, {})
    assert (spec.search.batch_size, spec.search.max_in_flight_tasks, spec.search.task_poll_ms, spec.search.task_timeout_secs) == (1000, 8, 100, 300)
    assert (spec.runtime.snapshot_on_start, spec.runtime.flush_interval_ms, spec.runtime.checkpoint_every_events) == (True, 1000, 1000)
    assert spec.tables[0].snapshot_batch_size == 10_000
    assert spec.tables[0].database == "shop"
    assert spec.tables[0].settings == {"displayed_attributes": ("id", "name")}


@pytest.mark.parametrize("old, new, says", [
    ('url = "mysql://reader@127.0.0.1:3306/shop"', 'url = ""', "source.url is required"),
    ("server_id = 7", "server_id = 0", "server_id"),
    ("127.0.0.1", "db.example.net", "require_ssl"),
    ("http://localhost:7700", "", "search.host is required"),
    ("http://localhost:7700", "ftp://localhost", "http or https"),
    ("http://localhost:7700", "http://search.example.net", "https"),
    ('host = "http://localhost:7700"', 'host = "http://localhost:7700"\nbatch_size = 0', "batch_size"),
    ('host = "http://localhost:7700"', 'host = "http://localhost:7700"\nmax_in_flight_tasks = 0', "max_in_flight_tasks"),
    ("[search]", "[runtime]\nflush_interval_ms = 0\n[search]", "flush_interval_ms"),
    ("/shop", "", "names none"),
])
def test_service_rules(old, new, says):
    with pytest.raises(SpecError, match=says):
        parse(GOOD.replace(old, new), {})


@pytest.mark.parametrize("more, says", [
    ({"table": " "}, "table is required"), ({"index": ""}, "index is required"), ({"fields": ()}, "fields is empty"),
    ({"primary_key": "sku"}, "not among its fields"), ({"snapshot_batch_size": 0}, "snapshot_batch_size"),
    ({"fields": ("id", " ")}, "blank"), ({"fields": ("id", "id")}, "listed twice"), ({"watch_fields": ("",)}, "blank"),
    ({"field_aliases": {"name": "id"}}, "two fields become"), ({"displayed_attributes": ("nope",)}, "no document field"),
    ({"searchable_attributes": ("name", "name")}, "twice"), ({"ranking_rules": ("",)}, "blank"), ({"distinct_attribute": "nope"}, "no document field"),
])
def test_table_rules(more, says):
    assert any(says in p for p in with_table(**more).problems())


def test_attributes_go_by_the_alias():
    assert with_table(field_aliases={"name": "title"}, searchable_attributes=("title", "*"), ranking_rules=("a", "a")).problems() == []
    assert with_table(field_aliases={"id": "key"}).target_key == "key"


def test_a_mapping_may_not_be_given_twice_however_its_database_is():
    table = GOOD[GOOD.index("[[tables]]"):]
    with pytest.raises(SpecError, match="twice"):
        parse(GOOD + table.replace("[[tables]]", '[[tables]]\ndatabase = "shop"'), {})
    assert len(parse(GOOD + table.replace('index = "products"', 'index = "public"'), {}).tables) == 2


def test_secrets(tmp_path):
    path = tmp_path / "key"
    path.write_text("abc\r\n")
    assert secret("K", {"K_FILE": str(path)}) == "abc"
    assert secret("K", {"K": "x"}) == "x" and secret("K", {}) is None
    with pytest.raises(SpecError, match="not both"):
        secret("K", {"K": "x", "K_FILE": str(path)})
    path.write_text("\n")
    with pytest.raises(SpecError, match="empty"):
        secret("K", {"K_FILE": str(path)})
    spec = parse(GOOD, {"STRANDFLOW_SEARCH_API_KEY": "hidden"})
    assert spec.search.api_key == "hidden" and "hidden" not in repr(spec)


def test_loopback():
    assert all(map(is_loopback, ("localhost", "LOCALHOST", "127.4.5.6", "[::1]", "::1")))
    assert not any(map(is_loopback, ("example.net", "10.0.0.1")))


def test_file(tmp_path):
    (tmp_path / "c.toml").write_text(GOOD)
    assert load(tmp_path / "c.toml", {}).tables[0].index == "products"

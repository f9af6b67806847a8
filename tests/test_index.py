"""The fault-code index of several manuals at once: nothing crosses from one manual to another."""

from faultlake.operators import dtc_index as I


def index(spark):
    rows = [("a", 1, "P0A0D", 12, "EVB-12", "pump"), ("a", 2, "P0A1F", 12, None, "fan"), ("b", 1, "P0A0D", 40, "EVB-12", "valve"), ("b", 2, "P0A0D", 12, "EVB-57", "valve"), ("b", 3, "U1000", 40, "EVB-12", "bus")]
    return spark.createDataFrame(rows, "doc string, seq long, code string, page int, page_ref string, title string")



def test_lists_of_two_manuals(spark):
    ix = index(spark)
    assert {(r.doc, r.page): (r.codes, r.page_ref) for r in I.codes_by_page(ix).collect()} == {("a", 12): (["P0A0D", "P0A1F"], "EVB-12"), ("b", 40): (["P0A0D", "U1000"], "EVB-12"), ("b", 12): (["P0A0D"], "EVB-57")}
    assert {(r.doc, r.code): (r.pages, r.page_refs, r.title) for r in I.pages_by_code(ix).collect()} == {
        ("a", "P0A0D"): ([12], ["EVB-12"], "pump"), ("a", "P0A1F"): ([12], [None], "fan"), ("b", "P0A0D"): ([40, 12], ["EVB-12", "EVB-57"], "valve"), ("b", "U1000"): ([40], ["EVB-12"], "bus")}
    assert {(r.doc, r.page_ref): r.page for r in I.footer_map(ix).collect()} == {("a", "EVB-12"): 12, ("b", "EVB-12"): 40, ("b", "EVB-57"): 12}
    assert I.union_of_pages(ix.union(ix)).count() == 5


def test_references_lead_to_pages_of_their_own_manual(spark):
    foot = I.footer_map(index(spark))
    matches = spark.createDataFrame([("a", 1, "EVB-12", None, None), ("b", 1, "EVB-12", None, None), ("a", 2, "EVB-57", "EVB-1", 7), ("b", 2, "EVB-57", "EVB-1", 7)], "doc string, seq int, ref string, link_ref string, link_page int")
    assert {(r.doc, r.seq): r.page for r in I.resolve_page(matches, foot, drop_unresolved=True).collect()} == {("a", 1): 12, ("b", 1): 40, ("a", 2): None, ("b", 2): 12}
    table = spark.createDataFrame([("a", 1, 1, "P1", True, "EVB-12"), ("b", 1, 1, "P1", True, "EVB-12")], "doc string, table_id int, row_no long, code string, has_ref boolean, ref string")
    links = spark.createDataFrame([], "doc string, table_id int, y0 double, ord long, link_ref string, link_page int, dest string")
    assert {r.doc: r.page for r in I.merge_groups_with_links(table, links, foot).collect()} == {"a": 12, "b": 40}

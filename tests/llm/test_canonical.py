import pytest

from faultlake.llm import canonical as C

LIST = [(1, "Norvane", "Lyra"), (2, "Norvane", "Lyra Plus"), (3, "Celtro", "Tern"), (4, "Velorra", "Tern"), (5, "Brisk & Lowe", "Courier 1"), (6, "Brisk & Lowe", "Courier 2"), (7, "Velorra", "Étincelle"),
        (8, "Kaltbach", "E 60"), (9, "Kaltbach", "E 60 Kombi"), (10, "Pelligro", "P9"), (11, "Solvik", "Fjordling")]
CASES = [("Norvane", "lyra plus AWD", 2), ("Norvane", "Lyra (2020)", 1), ("Lyra", "Norvane", 1), (None, "Norvane Lyra Plus", 2), ("Nrovane", "Lyra", 1), ("Norv.", "Lyra", 1), ("Celtro", "Tern", 3), ("velorra ltd", "TERN", 4),
         ("unknown", "Tern", 0), (None, "Courier2", 6), ("Brisk & Lowe", "Curie r1", 5), ("Brisk & Lowe", "Courier 3", 0), ("Velorra", "Etincele", 7), ("Kaltbach", "E60Kombi", 9), ("Kaltbach", "E 60 MY22", 8),
         ("Реlligrо", "P9", 10), ("Solvik", "Fj0rd1ing", 11), ("Norvane", None, 0), ("Norvane", "Zwirnrad", 0), ("", "", 0), ("???", "n/a", 0), ("Obstmann", "Garrulex", 0), ("Pelligro P9", None, 10), ("x" * 5000, "y" * 5000, 0)]


@pytest.mark.parametrize("make, model, want", CASES)
def test_cases(make, model, want):
    assert C.Matcher(LIST).find(make, model) == want


def test_tables(spark):
    manuals = spark.createDataFrame([("d1", ("Norvane", "Lyra")), ("d1", ("Norvane", "Lyra")), ("d2", (None, None)), ("d3", None), ("d4", ("Celtro", "Zwirnrad")), (None, ("Celtro", "Tern"))],
                                    "document_id string, vehicle struct<make:string,model:string>").selectExpr("*", "9 as model_id")
    entries = spark.createDataFrame(LIST + [(12, None, None)], "model_id int, make string, model string")
    assert sorted(map(tuple, C.manual_models(manuals, entries).collect())) == [("d1", 1), ("d4", 0)]
    assert [tuple(r) for r in C.unmatched(manuals, entries).collect()] == [("Celtro", "Zwirnrad", 1)]
    assert {r.model_id for r in C.manual_models(manuals, entries.limit(0)).collect()} == {0}
    assert C.manual_models(manuals.limit(0), entries).count() == 0


def test_slips_in_a_long_list():
    import random
    import time

    rng = random.Random(2)
    entries = [(k, f"Make {''.join(rng.choice('abcdefghijklmnopqrstuvwxyz') for _ in range(6))}", "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))) for k in range(20_000)]
    matcher = C.Matcher(entries)
    began = time.time()
    for number, make, model in rng.sample(entries, 50):
        i = rng.randrange(1, 8)
        assert matcher.find(make, model[:i] + model[i] + model[i:]) == number  # a doubled letter
        assert matcher.find(None, model[:i] + model[i] + model[i:]) == number
    assert time.time() - began < 50  # half a second a value, where each name of the list is compared it takes seconds


def test_values_of_a_third_of_all_rows(spark):
    entries = spark.createDataFrame([(1, "Celtro", "Bastionne"), (2, "Velorra", "Brindille")], "model_id int, make string, model string")
    rows = [(f"d{k}", ("Celtro", "Batsionne")) if k % 3 else (f"d{k}", (None, "Birndille")) for k in range(300)] + [("e", (None, None)), ("f", None), (None, ("Celtro", "x")), ("g", ("Celtro", None))]
    got = {r.document_id: r.model_id for r in C.manual_models(spark.createDataFrame(rows + rows[:9], "document_id string, vehicle struct<make:string,model:string>"), entries).collect()}
    assert got == {**{f"d{k}": 1 if k % 3 else 2 for k in range(300)}, "g": 0}

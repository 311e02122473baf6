"""The model-input conjunction on literal edge rows (FIXTURES: each label value,
a blank in each filtered column, bounds of both open ranges)."""

from quarry.plans.analog import model_filter

COLS = ["id", "Client_Type", "Service_B", "Service_R", "Com_Method", "S_years", "R_years", "active", "Educ", "hired"]
GOOD = dict(Client_Type="t", Service_B="b", Service_R="r", Com_Method="m", S_years=20.0, R_years=0.0,
            active="a", Educ="[[[x, y]]]", hired="1")


def _row(i, **over):
    d = dict(GOOD, **over)
    return tuple([i] + [d[c] for c in COLS[1:]])


def test_model_filter_edges(spark):
    cases = {
        1: ({}, True),
        2: ({"hired": "0"}, True),
        3: ({"hired": "3"}, False),
        4: ({"hired": "No"}, False),
        5: ({"hired": ""}, False),
        6: ({"hired": None}, False),
        7: ({"Client_Type": ""}, False),
        8: ({"Service_B": ""}, False),
        9: ({"Service_R": None}, False),
        10: ({"Com_Method": ""}, False),
        11: ({"active": ""}, False),
        12: ({"Educ": ""}, False),
        13: ({"S_years": 10.0}, False),
        14: ({"S_years": 11.0}, True),
        15: ({"S_years": 39.0}, True),
        16: ({"S_years": 40.0}, False),
        17: ({"R_years": -32.0}, False),
        18: ({"R_years": -31.0}, True),
        19: ({"R_years": 52.0}, True),
        20: ({"R_years": 53.0}, False),
        21: ({"hired": "1.0"}, True),
    }
    rows = [_row(i, **over) for i, (over, _) in cases.items()]
    schema = ("id int, Client_Type string, Service_B string, Service_R string, Com_Method string, "
              "S_years double, R_years double, active string, Educ string, hired string")
    kept = {r.id for r in model_filter(spark.createDataFrame(rows, schema)).collect()}
    assert kept == {i for i, (_, keep) in cases.items() if keep}

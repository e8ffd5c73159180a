"""The command line runs layers as separate steps over written tables."""

import json

from orrery.__main__ import main
from orrery.session import unique_name, work_root


def test_layers_one_by_one(spark, sf_small, capsys):
    root = work_root(spark, unique_name("test-cli"))
    args = ["--input", sf_small, "--root", root]
    for layer in ("bronze", "silver", "gold", "recommend"):
        main(["layer", layer, *args])
    counts = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert counts == {"recommendations": {"written": 1500, "rejected": 0}}
    main(["layer", "gold", *args])  # a re-run publishes a new version
    gold = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert gold["fact_ratings"] == {"written": 3542, "rejected": 0}

"""A fit depends on the rows, the key and the seed: the same trees for any
number of cores and input files."""

import dataclasses
import json
import os
import subprocess
import sys
import tempfile

import pytest

from roadframe.plans import catalog
from roadframe.plans.recipes import RECIPES, run_recipe

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def small(name):
    """A recipe with few and shallow trees."""
    params = dict(RECIPES[name].estimator_params) | {"max_depth": 3}
    if "forest" in RECIPES[name].estimator:
        params["num_trees"] = 3
    return dataclasses.replace(RECIPES[name], estimator_params=params)


def trees(clean, names=sorted(RECIPES)):
    return {name: run_recipe(clean, small(name), partitions=8).model.stages[-1].toDebugString.split("\n", 1)[1]
            for name in names}


def on_cores(cores):
    code = ("import json, sys, tempfile\n"
            f"sys.path[:0] = [{ROOT!r}, {os.path.join(ROOT, 'tests')!r}]\n"
            "from roadframe.session import build_session\n"
            "from roadframe.plans import catalog\n"
            "import test_fit_layout as t\n"
            f"spark = build_session('local[{cores}]', {cores}, extra={{'spark.checkpoint.dir': tempfile.mkdtemp()}})\n"
            "print('TREES' + json.dumps(t.trees(catalog.clean(spark, '/root/testdata/sf0.001'))))\n")
    done = subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, text=True)
    return json.loads(done.stdout.rpartition("TREES")[2])


def test_same_trees_on_any_number_of_cores():
    assert on_cores(2) == on_cores(4)


@pytest.mark.parametrize("name", ["1a", "5"])
def test_same_trees_from_any_number_of_files(spark, sf_dir, name):
    clean = catalog.clean(spark, sf_dir)
    found = []
    for files in (1, 8):
        path = tempfile.mkdtemp(prefix="layout-") + "/clean"
        clean.repartition(files).write.parquet(path)
        found.append(trees(spark.read.parquet(path), [name]))
    assert found[0] == found[1]

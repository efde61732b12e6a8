from types import SimpleNamespace

import pytest

from stackweave import session


def fake(master, folder=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_the_folder_of_the_cluster_is_used():
    assert session.shared_folder(fake("yarn", "s3a://work/")) == "s3a://work"


def test_only_a_local_master_may_use_this_machine():
    first = session.shared_folder(fake("local[8]"))
    assert session.shared_folder(fake("local[8]")) == first
    with pytest.raises(ValueError):
        session.shared_folder(fake("spark://host:7077"))


def test_new_folders_differ():
    spark = fake("yarn", "/shared")
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")

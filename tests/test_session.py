"""The shared folder: the setting, what is given to the context, and what is left when a session ends."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
RUN = """
import sys
sys.path.insert(0, {root!r})
from skein.session import checkpointed, delete_folder, local_session, shared_folder
conf = {conf!r}
spark = local_session("folders", cores=1, shuffle_partitions=1, **conf)
if {given!r}:
    spark.sparkContext.setCheckpointDir({given!r})
made = checkpointed(spark.range(5).repartition(2))
folder = shared_folder(spark, "rows")
made.write.parquet(folder)
print(spark.read.parquet(folder).count(), folder)
print(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
spark.stop()
"""


def session(conf, given=""):
    said = subprocess.run([sys.executable, "-c", RUN.format(root=str(ROOT), conf=conf, given=given)], capture_output=True, text=True)
    assert said.returncode == 0, said.stderr[-2000:]
    first, second = said.stdout.split("\n")[:2]
    assert second == "false"
    n, folder = first.split()
    assert n == "5"
    return folder


def left(folder):
    return [p for p in Path(folder).rglob("*") if p.is_file() and not p.name.startswith(".")]


def test_folder_of_the_setting(tmp_path):
    for named in (f"file://{tmp_path}/one", f"{tmp_path}/two"):
        folder = session({"spark.checkpoint.dir": named})
        assert f"{tmp_path}/" in folder and left(tmp_path) == []


def test_folder_given_to_the_context(tmp_path):
    folder = session({"spark.checkpoint.dir": f"{tmp_path}/named"}, f"{tmp_path}/given")
    assert f"{tmp_path}/given" in folder and not any("rows-" in str(p) for p in left(tmp_path))


def test_local_folder_where_none_is_named(tmp_path):
    folder = session({})
    assert not Path(folder.removeprefix("file:")).exists()


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest

    from skein.session import _base

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        _base(Session)

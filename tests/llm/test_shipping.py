import subprocess
import sys

from quarry.llm.queries import packed


def test_the_package_runs_from_its_zip(tmp_path):
    path = packed(str(tmp_path))
    code = "import quarry.llm.langid, quarry.llm.wrapper, quarry.llm.vafile as v; assert 'quarry.zip' in v.__file__; print('ok')"
    done = subprocess.run([sys.executable, "-c", code], env={"PYTHONPATH": path, "PATH": "/usr/bin:/bin"}, cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "ok", done.stderr[-500:]


def test_contexts_list_what_was_shipped(spark):
    assert isinstance(spark.sparkContext.listFiles, list)

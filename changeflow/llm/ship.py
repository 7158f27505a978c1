"""Giving the executors the code that tasks run."""

from __future__ import annotations

import functools
import io
import os
import zipfile

import changeflow
from changeflow.session import scratch_dir
from changeflow.sources.paths import write_bytes

_sent: set[str] = set()


def _send(spark) -> None:
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(changeflow.__file__))
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("changeflow", os.path.relpath(full, root)))
    path = f"{scratch_dir(spark, 'code')}/changeflow.zip"
    write_bytes(spark, path, content.getvalue())
    context.addPyFile(path)
    _sent.add(context.applicationId)


def shipped(job):
    """A job whose first argument is a session: this package goes along, once a session."""

    @functools.wraps(job)
    def run(spark, *args):
        _send(spark)
        return job(spark, *args)

    return run

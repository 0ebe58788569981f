"""Single files out of tables whose rows and partitions are in order."""

from __future__ import annotations

import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame


def write_ordered(body: DataFrame, head: list[str], tail: list[str], path: str) -> None:
    """The lines of head, `value` of every row and the lines of tail as one UTF-8 text file, which takes the place of what was at `path` in one step.

    Each partition's lines are written by its own task, and the pieces are joined by the file system where it can do that (no byte is moved); else the
    driver's JVM copies them from stream to stream, 64 KB at a time. A reader sees the old file or the new one whole; a run that dies leaves a
    hidden folder beside it. Other visible files of the folder are removed at the end, so that it holds one document."""
    spark = body.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs
    final = hadoop.Path(path)
    fs = final.getFileSystem(conf)
    temp = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    body.select("value").write.text(f"{temp}/body")
    parts = sorted((f.getPath() for f in fs.listStatus(hadoop.Path(f"{temp}/body")) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    whole, end = hadoop.Path(f"{temp}/whole"), hadoop.Path(f"{temp}/end")
    for at, lines in ((whole, head), (end, tail)):
        out = fs.create(at, True)
        out.write(bytearray("".join(f"{x}\n" for x in lines).encode()))
        out.close()
    whole = _joined(spark, fs, whole, [*parts, end], hadoop.Path(f"{temp}/copy"))
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(final.toUri(), conf).rename(whole, final, overwrite)
    fs.delete(hadoop.Path(temp), True)
    for f in fs.listStatus(final.getParent()):
        name = f.getPath().getName()
        if f.isFile() and name != final.getName() and name[0] not in "._":
            fs.delete(f.getPath(), False)


def _joined(spark, fs, first, rest: list, copy):
    """The path of first with the rest behind it."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    array = gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(rest))
    for i, p in enumerate(rest):
        array[i] = p
    try:
        fs.concat(first, array)
        return first
    except UnsupportedOperationException:
        pass
    out = fs.create(copy, True)
    for p in [first, *rest]:
        source = fs.open(p)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
        source.close()
    out.close()
    return copy

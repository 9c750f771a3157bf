"""The control table as a folder of versions, changed by compare-and-set.

A version is a written table (``data/<id>``) and a numbered commit that names it
and its parent::

    <path>/data/<id>/...parquet      written first, unseen until it is named
    <path>/commit/0000000007         created only if there is no such file

A change reads the latest version, writes the changed table and creates the next
commit.  If another job has created that number meanwhile, the change starts anew
from that job's version, so no job's change is lost and two jobs that claim from
one version never get the same request.

A claim happens before a request is served: its flag turns to ``No`` at once, and
the run and the former flag are noted beside it.  ``finish`` drops the note once
the report is written, ``release`` gives the requests back; the claims of a job
that died stay visible in ``claims`` until they are released.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adinsight import schemas
from adinsight.sources import requests as R

# The request table and who has claimed a row, with the flag it had before.
CONTROL = T.StructType([*schemas.REQUEST_RAW.fields,
                        T.StructField("claim_run", T.StringType()), T.StructField("claim_flag", T.StringType())])


class ControlTable:
    """The control table under ``path``; it is made by the first ``add`` or ``put``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # -- versions -----------------------------------------------------------
    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}")

    @property
    def _fs(self):
        return self._hadoop.Path(self.path).getFileSystem(self._conf)

    def version(self) -> int:
        """Number of the latest version; 0 if there is none."""
        fs, folder = self._fs, self._at("commit")
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def commit(self, version: int) -> dict:
        """What a commit says: the data folder and the parent's number."""
        stream = self._fs.open(self._at(f"commit/{version:010d}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def data_path(self, version: int | None = None) -> str:
        return f"{self.path}/data/{self.commit(version or self.version())['data']}"

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the latest), with the claim columns."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], CONTROL)
        return self.spark.read.schema(CONTROL).parquet(self.data_path(version))

    def requests(self) -> DataFrame:
        """The latest version as a request table."""
        return self.read().select(*[F.col(f"`{c}`") for c in schemas.REQUEST_RAW.fieldNames()])

    def _created(self, version: int, text: str) -> bool:
        """Create a commit whole, unless its number is taken.

        The file is written aside and given its name by an operation that fails
        if the name exists: a link on a local disk, a rename elsewhere.
        """
        fs, aside, target = self._fs, self._at(f"aside/{uuid.uuid4().hex}"), self._at(f"commit/{version:010d}")
        fs.mkdirs(target.getParent())
        stream = fs.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        jvm = self.spark.sparkContext._jvm
        try:
            if fs.getUri().getScheme() == "file":
                nio = jvm.java.nio.file
                there, here = (nio.Paths.get(fs.makeQualified(p).toUri()) for p in (target, aside))
                nio.Files.createLink(there, here)
            else:
                none = self.spark.sparkContext._gateway.new_array(self._hadoop.Options.Rename, 0)
                self._hadoop.FileContext.getFileContext(fs.getUri(), self._conf).rename(
                    fs.makeQualified(aside), fs.makeQualified(target), none)
        except Py4JJavaError as e:
            if not e.java_exception.getClass().getSimpleName().startswith("FileAlreadyExists"):
                raise
            return False
        finally:
            fs.delete(aside, False)
        return True

    def change(self, make: Callable[[DataFrame], DataFrame]) -> int:
        """Replace the table by ``make`` of it; returns the version that holds the result.

        ``make`` sees the latest version and may run several times.
        """
        while True:
            parent, name = self.version(), uuid.uuid4().hex
            make(self.read(parent)).select(*[F.col(f"`{c}`") for c in CONTROL.fieldNames()]).write.parquet(f"{self.path}/data/{name}")
            if self._created(parent + 1, json.dumps({"data": name, "parent": parent})):
                return parent + 1
            self._fs.delete(self._at(f"data/{name}"), True)  # never named by a commit

    # -- rows ---------------------------------------------------------------
    def _rows(self, rows: DataFrame) -> DataFrame:
        R.check_identity(rows)
        return rows.select(*[F.col(f"`{c}`") for c in schemas.REQUEST_RAW.fieldNames()])

    def add(self, rows: DataFrame) -> int:
        """Add the ``rows`` whose ``sheet_row`` is not in the table yet."""
        rows = self._rows(rows)
        return self.change(lambda t: t.unionByName(rows.join(t.select("sheet_row"), "sheet_row", "left_anti"),
                                                   allowMissingColumns=True))

    def put(self, rows: DataFrame) -> int:
        """Add ``rows``, or put them in the place of those with their ``sheet_row``; open claims stay."""
        rows = self._rows(rows)

        def make(t: DataFrame) -> DataFrame:
            claims = t.select(F.col("sheet_row").alias("_row"), "claim_run", "claim_flag")
            new = rows.join(claims, F.col("sheet_row") == F.col("_row"), "left").drop("_row")
            return t.join(rows.select("sheet_row"), "sheet_row", "left_anti").unionByName(new)
        return self.change(make)

    # -- claims -------------------------------------------------------------
    def claim(self, run: str, first_only: bool = False) -> DataFrame:
        """Claim all pending requests (or the first) for ``run``; returns them as they were flagged."""
        def make(t: DataFrame) -> DataFrame:
            pending = t.filter(R.is_pending() & F.col("claim_run").isNull())
            chosen = (pending.orderBy("sheet_row").limit(1) if first_only else pending).select(
                F.col("sheet_row").alias("_row"))
            hit = F.col("_row").isNotNull()
            marked = t.join(chosen, F.col("sheet_row") == F.col("_row"), "left")
            return marked.withColumns({
                "claim_run": F.when(hit, F.lit(run)).otherwise(F.col("claim_run")),
                "claim_flag": F.when(hit, F.col("Insight_Flag")).otherwise(F.col("claim_flag")),
                "Insight_Flag": F.when(hit, F.lit(R.CLAIMED_FLAG)).otherwise(F.col("Insight_Flag"))}).drop("_row")
        mine = self.read(self.change(make)).filter(F.col("claim_run") == run)
        return mine.withColumn("Insight_Flag", F.col("claim_flag")).select(
            *[F.col(f"`{c}`") for c in schemas.REQUEST_RAW.fieldNames()])

    def claims(self) -> DataFrame:
        """Requests that a run has claimed and neither finished nor released."""
        return self.read().filter(F.col("claim_run").isNotNull()).select("sheet_row", "claim_run", "claim_flag")

    def _settled(self, run: str, flag) -> int:
        def make(t: DataFrame) -> DataFrame:
            mine = F.coalesce(F.col("claim_run") == run, F.lit(False))
            return t.withColumns({"Insight_Flag": F.when(mine, flag).otherwise(F.col("Insight_Flag")),
                                  "claim_run": F.when(~mine, F.col("claim_run")),
                                  "claim_flag": F.when(~mine, F.col("claim_flag"))})
        return self.change(make)

    def finish(self, run: str) -> int:
        """The run's requests are served; a flag that was set anew meanwhile stays."""
        return self._settled(run, F.col("Insight_Flag"))

    def release(self, run: str) -> int:
        """Give the run's requests back, with the flags they had."""
        untouched = F.col("Insight_Flag") == R.CLAIMED_FLAG
        return self._settled(run, F.when(untouched, F.col("claim_flag")).otherwise(F.col("Insight_Flag")))

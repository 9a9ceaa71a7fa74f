"""Gridded forecasts: projection, cube and nearest-cell series."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



@dataclass(frozen=True)
class LambertGrid:
    """A regular grid on a Lambert conformal conic projection of a sphere."""

    nx: int
    ny: int
    dx: float
    dy: float
    lon0: float
    lat0: float
    radius: float
    central_lat: float
    central_lon: float
    secant_lat_1: float
    secant_lat_2: float

    def _cone(self) -> tuple[float, float, float]:
        """Cone constant, scale and the radius of the central latitude (Snyder 1987, 15-1 to 15-3)."""

        def t(lat: float) -> float:
            return math.tan(math.pi / 4 + math.radians(lat) / 2)

        lat1, lat2 = math.radians(self.secant_lat_1), math.radians(self.secant_lat_2)
        if abs(lat1 - lat2) < 1e-12:
            n = math.sin(lat1)
        else:
            n = math.log(math.cos(lat1) / math.cos(lat2)) / math.log(t(self.secant_lat_2) / t(self.secant_lat_1))
        scale = self.radius * math.cos(lat1) * t(self.secant_lat_1) ** n / n
        return n, scale, scale / t(self.central_lat) ** n

    def project(self, lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
        """Plane coordinates of lon / lat columns, in the unit of ``radius``."""
        lon = F.col(lon) if isinstance(lon, str) else lon
        lat = F.col(lat) if isinstance(lat, str) else lat
        n, scale, rho0 = self._cone()
        rho = F.lit(scale) / F.pow(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2), F.lit(n))
        turn = lon - self.central_lon
        turn = turn - F.floor((turn + 180) / 360) * 360
        theta = F.radians(turn) * n
        return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)

    def origin(self) -> tuple[Column, Column]:
        return self.project(F.lit(self.lon0), F.lit(self.lat0))


def grid_cube(messages: DataFrame, grid: LambertGrid) -> DataFrame:
    """One row per message and cell: ``valid_time, iy, ix, y, x, value``."""
    x0, y0 = grid.origin()
    carried = [c for c in messages.columns if c != "values"]
    return (
        messages.select(*carried, F.posexplode("values").alias("cell", "value"))
        .withColumns({"iy": F.floor(F.col("cell") / grid.nx).cast("int"), "ix": (F.col("cell") % grid.nx).cast("int")})
        .withColumns({"y": y0 + F.col("iy") * grid.dy, "x": x0 + F.col("ix") * grid.dx})
        .select(*carried, "iy", "ix", "y", "x", "value")
    )


def nearest_cell(points: DataFrame, grid: LambertGrid, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add the indices of the closest grid cell; points outside take the edge cell."""
    x, y = grid.project(lon, lat)
    x0, y0 = grid.origin()

    def index(at: Column, start: Column, step: float, count: int) -> Column:
        return F.least(F.greatest(F.floor((at - start) / step + 0.5), F.lit(0)), F.lit(count - 1)).cast("int")

    return points.withColumns({"iy": index(y, y0, grid.dy, grid.ny), "ix": index(x, x0, grid.dx, grid.nx)})


def grid_series(messages: DataFrame, points: DataFrame, grid: LambertGrid) -> DataFrame:
    """Forecast series of every point, by an equi-join on its cell.

    The wanted cells, at most as many as the grid has, are one array in the plan; a message's
    values are picked by it, so it leaves one row per wanted cell, not one per cell.
    """
    located = nearest_cell(points, grid)
    cell = F.col("iy") * grid.nx + F.col("ix")
    wanted = located.select(cell.alias("cell")).agg(F.array_sort(F.collect_set("cell")).alias("cells")).scalar()
    picked = (
        messages.select("valid_time", "values", F.explode(wanted).alias("cell"))
        .filter(F.col("cell") < F.size("values"))
        .select("valid_time", "cell", F.get("values", F.col("cell")).alias("value"))
    )
    placed = picked.select(
        "valid_time",
        F.floor(F.col("cell") / grid.nx).cast("int").alias("iy"),
        (F.col("cell") % grid.nx).cast("int").alias("ix"),
        "value",
    )
    return placed.join(located, ["iy", "ix"])

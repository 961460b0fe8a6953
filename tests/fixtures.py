"""Hand-made inputs."""

from __future__ import annotations

import os
from datetime import date
from decimal import Decimal

import pyarrow as pa

TRADE = (
    '{"coin":"BTC","px":"100.50","sz":"2","side":"A","time":"2025-04-01T00:00:01.250Z","hash":"0xt1",'
    '"side_info":[{"user":"0xa","start_pos":"0","oid":1},{"user":"0xb","start_pos":"5","oid":2,"cloid":"c2"}]}'
)
FILL = (
    '["0xa",{"coin":"ETH","px":"2000.10","sz":"0.5","side":"B","time":1750000000000,"hash":"0xf1","oid":7,"tid":70,'
    '"startPosition":"0","dir":"Open Long","closedPnl":"0.0","crossed":true,"fee":"0.25","feeToken":"USDC"}]'
)
BLOCK = (
    '{"block_number":9,"block_time":"2025-08-01T00:00:00","local_time":"2025-08-01T00:00:00.1","events":['
    '["0xa",{"coin":"BTC","px":"10","sz":"1","side":"A","time":1754006400000,"hash":"0xk","builder":"0xz",'
    '"builderFee":"0.01"}],'
    '["0xb",{"coin":"BTC","px":"10","sz":"1","side":"B","time":1754006400000,"hash":"0xk"}]]}'
)

FILLS = "date date, user_address string, coin string, side string, px decimal(18,8), sz decimal(18,8), hash string"
TOTALS = "user_address string, date date, daily_volume decimal(38,16)"


def day(number: int, month: int = 8) -> date:
    return date(2025, month, number)


def fill(user, coin="BTC", side="A", px="100", sz="1", hash_="h1", on=None):
    return (on or day(1), user, coin, side, Decimal(px), Decimal(sz), hash_)


def raw(spark, dataset: str, *lines: str, on: date | None = None):
    return spark.createDataFrame(
        [(dataset, on or day(1), line) for line in lines], "dataset string, date date, value string"
    )


def put_raw(root: str, dataset: str, directory: str, hour: str, lines: list[str]) -> None:
    target = os.path.join(root, dataset, "hourly", directory)
    os.makedirs(target, exist_ok=True)
    with pa.CompressedOutputStream(os.path.join(target, f"{hour}.lz4"), "lz4") as out:
        out.write(("\n".join(lines) + "\n").encode())


def as_rows(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns or df.columns).collect()), key=str)

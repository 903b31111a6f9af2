"""Schemas of the raw layer; money and sizes are strings there."""

from __future__ import annotations

TRADES_PERPS = "timestamp_utc string, exchange string, market string, instId string, symbol_canon string, trade_id string, side string, price string, qty_contracts string, ctVal string, ctMult string, ctType string"
TRADES_SPOT = "exchange string, symbol string, trade_id string, timestamp_utc string, price string, size string, side string"
CONTRACT = "instId string, ctVal string, ctMult string, ctType string, tickSz string, lotSz string"
INSTRUMENTS = f"{CONTRACT}, normalized struct<instId:string,ctVal:string,ctMult:string,ctType:string,tickSz:string,lotSz:string>, raw struct<instId:string,ctVal:string,ctMult:string,ctType:string,tickSz:string,lotSz:string>"
LEVELS = "array<array<string>>"
BOOK = f"timestamp_utc string, instId string, mid_price string, best_bid string, best_ask string, bids {LEVELS}, asks {LEVELS}, bids_top200 {LEVELS}, asks_top200 {LEVELS}, bids_top400 {LEVELS}, asks_top400 {LEVELS}, checksum long, seqId long, prevSeqId long, gap_detected boolean"
DERIVATIVES = {
    "open_interest": "symbol string, history array<struct<t:long,o:double>>",
    "liquidations": "symbol string, history array<struct<t:long,lq:double,s:string>>",
    "funding": "symbol string, history array<struct<t:long,fr:double>>",
    "long_short_ratio": "symbol string, history array<struct<t:long,ls:double>>",
}

"""Declared schemas of the input tables, as Spark DDL."""

from __future__ import annotations

SCHEMAS: dict[str, str] = {
    "network_feed": "msg_timestamp timestamp_ntz, node_id string, peer_id string, msg_type string, "
    "msg_data array<string>",
    "eth_transaction": "blk_number bigint, blk_timestamp timestamp_ntz, tx_hash string, tx_index int, "
    "tx_status int, tx_from string, tx_to string, tx_gas_price double, tx_gas_used double, tx_value double, "
    "inserted_at timestamp_ntz",
    "block_header": "blk_number bigint, blk_hash binary",
    "ethernodes_tracker": "node_id string, host_address string, isp string, country string, "
    "client_type string, client_version string, os string, in_sync boolean, last_seen timestamp_ntz",
    "node_tracker": "node_id string, host string, port int, country string, client string, type string, "
    "os string, last_seen timestamp_ntz",
    "country_code": "country_code string, country_name string, region string",
    "geo_blocks": "start_ip bigint, end_ip bigint, country_code string, city string, subdivision string",
    "run_ledger": "run_timestamp timestamp_ntz, blockchain string, incremental_table string, "
    "run_completed boolean, run_start_blk_number bigint, run_stop_blk_number bigint",
    "peer_session_keys": "peer_id string, node_id string, start_time timestamp_ntz, end_time timestamp_ntz",
    "mempool_transaction": "tx_hash string, first_seen_at timestamp_ntz, updated_at timestamp_ntz",
}

# Tables that are declared but that no job reads; the loader takes their schema from the files.
UNREAD_TABLES = (
    "erc20_transfer",
    "erc721_transfer",
    "erc1155_transfer",
    "eth_balance_change",
    "weth_deposit_withdrawal",
    "contract_deployment",
    "uniswap_v3_pair_swap",
)

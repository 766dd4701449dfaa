"""Tables in and out: declared schemas, file inventories, partitioned layouts and text exports."""

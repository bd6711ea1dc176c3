"""Sources and sinks: page scans, SQL tables, archives, text feeds, digest packs."""

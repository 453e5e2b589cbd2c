"""Sources and sinks: daily file scans, partition discovery, partitioned writes, serving loads."""

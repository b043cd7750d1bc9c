"""Writers: change log and state, rollup, JDBC, console."""

"""Writers: landing files, result files, staged publish, JDBC,
notifications."""

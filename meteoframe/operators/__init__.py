"""DataFrame -> DataFrame operators. All are lazy unless documented."""

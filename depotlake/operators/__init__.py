"""DataFrame operators of the warehouse; import the modules, they hold plain functions."""

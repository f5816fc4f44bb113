"""End-to-end plans over the driver's tables and over yearly CSV folders."""

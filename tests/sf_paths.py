"""Where the driver's tables are. Test modules import this one, never ``conftest``, of which there are two."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

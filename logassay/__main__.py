from logassay.cli import main

raise SystemExit(main())

from bourse.cli import main

main()

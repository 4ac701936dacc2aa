"""The command line modes on a small folder."""

import os

from sheetlake.__main__ import main


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_modes(spark, workdir):
    wh = f"{workdir}/wh"
    write(f"{workdir}/revenue/Năm 2025/r.csv",
          "Báo cáo\nKỳ\nĐơn vị\nMã hóa đơn,Số tiền\nHD1,5\nHD2,7\n")
    write(f"{workdir}/cancel/c.csv", "Báo cáo\nKỳ\nMã hóa đơn\nHD2\n")
    common = ["--warehouse", wh, "--revenue-dir", f"{workdir}/revenue", "--cancel-dir", f"{workdir}/cancel"]
    first = main(["--mode", "init", *common], spark=spark)
    assert first["files_processed"] == 2
    again = main(["--mode", "daily", *common], spark=spark)
    assert again["files_deleted"] == 0 and not again["errors"]
    write(f"{workdir}/script/live.sql",
          "SELECT count(*) AS n FROM sales_revenue s LEFT ANTI JOIN cancellation_bills c "
          "ON s.ma_hoa_don = c.ma_hoa_don")
    out = main(["--mode", "run_script", "--warehouse", wh, "--script-dir", f"{workdir}/script",
                "--out-dir", f"{workdir}/out"], spark=spark)
    assert len(out["ok"]) == 1
    assert spark.read.parquet(out["ok"][0]).collect()[0].n == 1


def test_report_views_over_landed_tables(spark, workdir):
    wh = f"{workdir}/wh"
    head = ("Báo cáo\nKỳ\nĐơn vị\nLoại dữ liệu,ID khách hàng,Khách hàng,PID,Loại doanh thu,Loại hóa đơn,"
            "Mã hóa đơn,Sản phẩm,Số lượng,Ngày ghi,Ngày cập nhật hóa đơn cuối,Số tiền thực tế thu,"
            "Tên đối tượng thanh toán,Doanh thu thực hiện\n")
    write(f"{workdir}/revenue/r.csv", head +
          "x,7,A,1,FnB,t,HD1,Cà phê,1,2026-03-01,2026-03-01 10:00:00,20,,20\n"
          "x,7,A,1,Khác,t,HD2,Phí,1,2026-03-02,2026-03-02 10:00:00,10,,10\n"
          "x,7,A,1,FnB,t,HD3,Trà,1,2026-03-02,2026-03-02 10:00:00,99,,99\n")
    write(f"{workdir}/customer/k.csv", "Báo cáo\nKỳ\nID,Tên khách hàng,PID,Giới tính,Ngày sinh,"
          "Chuyên viên tư vấn,Mức độ,Nguồn 1,Người giới thiệu ID,Người giới thiệu khách hàng PID,"
          "Người giới thiệu khách hàng,Người giới thiệu nội bộ,Có phúc lợi tập đoàn,Cấp quyền lợi áp dụng,"
          "Công ty 1,Tên bảo hiểm thanh toán,Quan hệ với cấp quyền lợi áp dụng,Ngày cuối cập nhật\n"
          "7,An,1,,32290.0,,,,,,,,,,,,,2026-01-01\n")
    write(f"{workdir}/cancel/c.csv", "Báo cáo\nKỳ\nMã hóa đơn\nHD3\n")
    common = ["--warehouse", wh, "--revenue-dir", f"{workdir}/revenue", "--cancel-dir", f"{workdir}/cancel",
              "--customer-dir", f"{workdir}/customer"]
    main(["--mode", "init", *common], spark=spark)
    write(f"{workdir}/script/s.sql", "SELECT id, tongdt, dt_fnb FROM customer_spending")
    write(f"{workdir}/script/d.sql", "SELECT * FROM daily_revenue")
    out = main(["--mode", "run_script", "--warehouse", wh, "--script-dir", f"{workdir}/script",
                "--out-dir", f"{workdir}/out"], spark=spark)
    assert not out["errors"], out["errors"]
    spend = [p for p in out["ok"] if "/s_" in p][0]
    r = spark.read.parquet(spend).collect()[0]
    assert (r.id, int(r.tongdt), int(r.dt_fnb)) == ("7", 22, 20)   # 20 + round(0.15 * 10); HD3 cancelled
